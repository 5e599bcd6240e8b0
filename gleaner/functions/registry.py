"""Functions for SQL: register(spark) makes them callable by name in the session."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gleaner.functions import html


def register(spark: SparkSession) -> list[str]:
    """main_content(html), page_title(html), page_links(html, base), to_text(body, charset) and the table function link_rows(html, base)."""

    @F.pandas_udf("string")
    def main_content(body: pd.Series) -> pd.Series:
        return body.map(lambda b: html.main_content(b) if b else b)

    @F.pandas_udf("string")
    def page_title(body: pd.Series) -> pd.Series:
        return body.map(lambda b: html.title(b) if b else b)

    @F.pandas_udf("array<string>")
    def page_links(body: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([html.links(b, u) if b and u else [] for b, u in zip(body, base)])

    @F.pandas_udf("string")
    def to_text(body: pd.Series, charset: pd.Series) -> pd.Series:
        return pd.Series([html.to_text(b, c) for b, c in zip(body, charset)])

    @F.udtf(returnType="place int, link string, kind string")
    class LinkRows:
        def eval(self, body: str, base: str):
            for kind in ("a", "css", "img"):
                for i, link in enumerate(html.links(body, base, kind) if body and base else []):
                    yield i, link, kind

    functions = {"main_content": main_content, "page_title": page_title, "page_links": page_links, "to_text": to_text}
    for name, f in functions.items():
        spark.udf.register(name, f)
    spark.udtf.register("link_rows", LinkRows)
    return [*functions, "link_rows"]
