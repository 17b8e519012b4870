"""Schemas at the stream boundary and the two literal dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

# Rows that the JSON source cannot read keep their text in this column.
CORRUPT = "_corrupt_record"

# Columns that say how a silver row came in, and nothing of what it says.
INGEST_TIME = "ingest_ts"
BATCH = "lote"
BOOKKEEPING = (INGEST_TIME, BATCH)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D = T.StringType(), T.DoubleType()

# --- fixed values: message and table layouts ---------------------------------
CLIMATE_RECORD = _schema(
    ("date", _S),
    ("hub", _S),
    ("state", _S),
    ("latitude", _D),
    ("longitude", _D),
    ("precipitation_mm", _D),
)
PRODUCTION_RECORD = _schema(
    ("data", _S),
    ("unidade_federativa", _S),
    ("produto", _S),
    ("producao", _D),
)
PRICE_RECORD = _schema(
    ("data", _S),
    ("último", _S),
    ("abertura", _S),
    ("máxima", _S),
    ("mínima", _S),
    ("vol.", _S),
    ("var%", _S),
)
PRODUCTION_CSV_COLUMNS = ("data", "unidade_federativa", "producao")
PRICE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Business keys: a replayed message repeats them.
PRODUCTION_KEY = ("data", "estado")
CLIMATE_KEY = ("data", "cidade")
PRICE_KEY = ("timestamp",)
CLIMATE_TABLE_KEY = ("date", "hub")
PRODUCTION_TABLE_KEY = ("data", "unidade_federativa")

HUB = _schema(
    ("hub", _S), ("state", _S), ("commodity", _S), ("lat", _D), ("lon", _D)
)
# --- fixed values: the weather stations' hubs --------------------------------
HUBS = [
    ("Sorriso", "MT", "Soja", -12.54, -55.71),
    ("Rio Verde", "GO", "Soja", -17.79, -50.92),
    ("Formoza do Rio Preto", "BA", "Soja", -11.05, -45.19),
    ("Sao Desiderio", "BA", "Soja", -12.36, -44.97),
    ("Nova Mutum", "MT", "Soja", -13.83, -56.09),
    ("Sapezal", "MT", "Soja", -13.55, -58.82),
    ("Diamantino", "MT", "Soja", -14.41, -56.45),
    ("Campo Novo do Perecis", "MT", "Soja", -13.67, -57.89),
    ("Nova Ubirata", "MT", "Soja", -12.99, -55.25),
    ("Querencia", "MT", "Soja", -12.6, -52.21),
]
GRID_YEARS = range(2015, 2026)
GRID = _schema(
    ("date", T.DateType()), ("latitude", _D), ("longitude", _D), ("precip", _D)
)

STATE = _schema(("sigla", _S), ("nome", _S))
# --- fixed values: Brazilian states, names without accents -------------------
STATES = [
    ("AC", "Acre"),
    ("AL", "Alagoas"),
    ("AM", "Amazonas"),
    ("AP", "Amapa"),
    ("BA", "Bahia"),
    ("CE", "Ceara"),
    ("DF", "Distrito Federal"),
    ("ES", "Espirito Santo"),
    ("GO", "Goias"),
    ("MA", "Maranhao"),
    ("MG", "Minas Gerais"),
    ("MS", "Mato Grosso do Sul"),
    ("MT", "Mato Grosso"),
    ("PA", "Para"),
    ("PB", "Paraiba"),
    ("PE", "Pernambuco"),
    ("PI", "Piaui"),
    ("PR", "Parana"),
    ("RJ", "Rio de Janeiro"),
    ("RN", "Rio Grande do Norte"),
    ("RO", "Rondonia"),
    ("RR", "Roraima"),
    ("RS", "Rio Grande do Sul"),
    ("SC", "Santa Catarina"),
    ("SE", "Sergipe"),
    ("SP", "Sao Paulo"),
    ("TO", "Tocantins"),
]
