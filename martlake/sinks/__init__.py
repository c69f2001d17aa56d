"""Writers: Parquet layers (optionally partitioned) and JDBC tables."""

from martlake.sinks.files import write_layer
from martlake.sinks.jdbc import jdbc_write_options, publish_jdbc, publish_layer

__all__ = ["jdbc_write_options", "publish_jdbc", "publish_layer", "write_layer"]
