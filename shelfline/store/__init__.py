from shelfline.store.tables import ForecastStore, append_run, delete_version, promote_version

__all__ = ["ForecastStore", "append_run", "delete_version", "promote_version"]
