from tenderline.sources.tables import Tables, read_jdbc, read_parquet
from tenderline.sources.derived import derive

__all__ = ["Tables", "derive", "read_jdbc", "read_parquet"]
