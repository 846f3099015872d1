from prepframe.sources.io import (  # noqa: F401
    file_to_table,
    load_model,
    read_csv,
    read_json,
    read_parquet,
    read_table,
    save_model,
    write_csv,
    write_parquet,
    write_table,
)
