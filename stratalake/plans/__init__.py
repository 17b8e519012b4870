"""The pipeline's stages, composed from the operators."""
