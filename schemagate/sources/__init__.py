from schemagate.sources.csv_files import read_csv
from schemagate.sources.json_files import read_json
from schemagate.sources.tables import preview

__all__ = ["preview", "read_csv", "read_json"]
