"""DataFrame -> DataFrame operators of the segmentation, one module per stream."""
