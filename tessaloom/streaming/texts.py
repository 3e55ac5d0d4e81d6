"""The operators of single rows over streams: they keep no state, so a stream takes them as a batch does."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessaloom.operators.clean import Options, cleaned


def clean_stream(stream: DataFrame, text: str, options: Options = Options()) -> DataFrame:
    """The cleaned rows of a stream, for writeStream."""
    if not stream.isStreaming:
        raise ValueError("not a stream")
    return cleaned(stream, text, options)
