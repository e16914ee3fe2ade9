"""Entry 4: weekly media CSV -> one recap sheet per channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchpath.config import MediaConfig
from touchpath.operators.media import media_recap
from touchpath.sinks.writers import write_report
from touchpath.sources.tables import normalise_columns, read_weekly_csv


def run_media(spark: SparkSession, csv_path: str, cfg: MediaConfig, output_dir: str | None = None, columns: list[str] | None = None,
              date_format: str = "dd/MM/yyyy", fmt: str = "csv") -> dict[str, DataFrame]:
    """S8 -> P20-P26, F9-F12, A13, J8, J9 -> S9.

    ``columns`` are the file's columns in order, if it holds more than those of
    the configured channels (``MediaConfig.csv_columns``). Names are normalised
    (S4). With ``output_dir`` each recap is written as a sheet.
    """
    weekly = normalise_columns(read_weekly_csv(spark, csv_path, columns or cfg.csv_columns, cfg.date_col, date_format))
    sheets = media_recap(weekly, cfg)
    if output_dir:
        write_report(sheets, output_dir, fmt)
    return sheets
