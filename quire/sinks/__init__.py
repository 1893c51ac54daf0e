from quire.sinks.files import (  # noqa: F401
    read_minute_archive, write_documents, write_minute_archive, write_records,
)
from quire.sinks.keyed import ConnectorTable, CountTable, KeyedTable  # noqa: F401
