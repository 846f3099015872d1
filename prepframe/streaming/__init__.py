from prepframe.streaming.apply import (  # noqa: F401
    read_stream,
    run_to_files,
    run_to_memory,
    score_stream,
    windowed_confusion,
)
