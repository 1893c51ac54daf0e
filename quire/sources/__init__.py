from quire.sources.files import (  # noqa: F401
    land_csv, land_lines, read_csv_rows, read_lines, read_reviews_csv,
)
from quire.sources import fixtures  # noqa: F401
