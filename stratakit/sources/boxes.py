"""Text boxes of PDF pages. The source contract is a table of boxes; files are read directly where ``pdfminer`` is installed."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from stratakit.schemas import PIPELINE

BOXES = "report string, page int, y0 double, y1 double, x0 double, x1 double, text string"


def read_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Pre-extracted boxes from Parquet."""
    return spark.read.schema(PIPELINE["boxes"]).parquet(path)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pdfminer.high_level import extract_pages  # optional
    from pdfminer.layout import LTFigure, LTTextLine

    def lines(node) -> Iterator:
        if isinstance(node, LTTextLine):
            yield node
        elif isinstance(node, LTFigure) or hasattr(node, "__iter__"):
            for child in node:
                yield from lines(child)

    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows = [(path, n, t.y0, t.y1, t.x0, t.x1, t.get_text()) for n, page in enumerate(extract_pages(io.BytesIO(content))) for t in lines(page)]
            yield pd.DataFrame(rows, columns=["report", "page", "y0", "y1", "x0", "x1", "text"])


def pdf_boxes(files: DataFrame) -> DataFrame:
    """Boxes of the PDF files among ``files`` (path, suffix, content); needs ``pdfminer`` on the workers."""
    return files.where("suffix = '.pdf'").select("path", "content").mapInPandas(_extract, BOXES)
