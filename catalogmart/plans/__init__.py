"""The catalogue's relations, layer by layer, as functions of DataFrames."""
