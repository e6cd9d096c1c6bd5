"""Writers for releases, debug rasters and validation results."""
