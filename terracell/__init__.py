"""terracell: Spark-native urban raster, feature-table and model operators.

Everything is a DataFrame: vector layers are feature tables, rasters are cell
tables ``(row, col, value)``, and each operator is a function from DataFrames
to a DataFrame, so Catalyst plans whole chains at once. The functions of
``terracell.api`` do the same by path and can be taken from here by name.
"""

__version__ = "0.1.0"

API = (
    "rasterize_buildings", "process_building_rasters", "calculate_distance_only", "calculate_allocation_only", "calculate_width_tiles_only",
    "create_empty_multiband_raster", "canyon_width_tiles", "process_width_raster_pipeline", "dem_full_pipeline", "lcz_prepair",
    "calculate_building_parameters", "restore_building_height_model", "predict_with_trained_model", "find_best_catboost_params",
    "rasterize_both_heights", "process_canyon_length", "rasterize_roads", "reproject_resample_clip", "rasterize_industrial", "create_multiband_raster",
)


def __getattr__(name: str):
    """The public functions, loaded when first asked for."""
    if name in API:
        import importlib

        return getattr(importlib.import_module("terracell.api"), name)
    raise AttributeError(f"module 'terracell' has no attribute {name!r}")
