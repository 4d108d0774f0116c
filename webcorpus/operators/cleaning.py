"""C1 + C2 + C4 over a pages table: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.text import clean_html, html_description, html_title


def clean_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``text``, ``text_hash``, ``title``, ``description``; drops the HTML."""
    out = (pages.withColumn("text", clean_html(html_col))
           .withColumn("title", html_title(html_col))
           .withColumn("description", html_description(html_col))
           .withColumn("text_hash", F.sha2("text", 256)))
    return out.drop(html_col)
