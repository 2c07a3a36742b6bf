"""HTML extraction as Spark jobs over a column of pages.

Regex extraction runs in the JVM (``split``/``regexp_extract(_all)``);
only HTML entity decoding goes through an Arrow-batched pandas UDF
(``html.unescape``), because Spark has no entity decoder.
"""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_MARKER = r'<li id="reviews__item__\d+" class="skp-review-item"'
# FIXED VALUES: field patterns of the review markup
P_UID = r'data-global-modal-review-id="([^"]+)"'
P_AUTHOR = r'(?s)<p class="skp-review-item__info">\s*(.*?)\s*</p>'
P_RATING = r'data-rating="(\d+)"'
P_DATE = r'(?s)<p class="skp-review-item__date">\s*(.*?)\s*</p>'
P_TEXT = r'(?s)<p class="skp-review-item__text[^"]*">\s*(.*?)\s*</p>'
P_EXPERIENCE = r'(?s)<p class="skp-review-item__summary">\s*Expérience du:\s*(.*?)\s*</p>'
P_RESP_HEADER = r'(?s)<p class="skp-review-moderation__header">\s*(.*?)\s*</p>'
P_RESP_TEXT = r'(?s)<div class="skp-review-moderation__text">\s*(.*?)\s*</div>'


@F.pandas_udf(T.StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else _html.unescape(v))


def py_strip(col) -> Column:
    """str.strip(): remove leading/trailing whitespace (not only spaces)."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def collapse_ws(col) -> Column:
    return F.regexp_replace(py_strip(col), r"\s+", " ")


def _first(block: Column, pattern: str) -> Column:
    """First capture group, entity-decoded and stripped; NULL when absent."""
    return F.when(block.rlike(pattern), py_strip(html_unescape(F.regexp_extract(block, pattern, 1))))


def _strip_tags(col: Column) -> Column:
    no_tags = F.regexp_replace(col, r"(?s)<[^>]+>", " ")
    return F.nullif(collapse_ws(html_unescape(no_tags)), F.lit(""))


def review_blocks(pages: DataFrame, page_col: str = "page_no", html_col: str = "html") -> DataFrame:
    """One row per review block (text after each block marker up to the next)."""
    parts = F.split(F.col(html_col), REVIEW_MARKER)
    return (pages.select(page_col, F.posexplode(parts).alias("block_pos", "block"))
                 .filter(F.col("block_pos") > 0))


def extract_reviews(pages: DataFrame, source: str = "review-site", materialize_first: bool = False):
    """Pages -> (reviews, responses). Blocks without id are dropped;
    a review id seen on several pages keeps its first occurrence."""
    b = review_blocks(pages)
    blk = F.col("block")
    rating = F.regexp_extract(blk, P_RATING, 1)
    rv = b.select(
        "page_no", "block_pos", _first(blk, P_UID).alias("review_uid"),
        collapse_ws(F.coalesce(_first(blk, P_AUTHOR), F.lit(""))).alias("author"),
        F.when(rating != "", rating.cast("int")).alias("rating"),
        _first(blk, P_DATE).alias("review_date_raw"),
        _first(blk, P_EXPERIENCE).alias("experience_date_raw"),
        collapse_ws(F.coalesce(_first(blk, P_TEXT), F.lit(""))).alias("review_text"),
        F.regexp_extract_all(blk, F.lit(P_RESP_HEADER), 1).alias("_h"),
        F.regexp_extract_all(blk, F.lit(P_RESP_TEXT), 1).alias("_t"),
    ).filter(F.col("review_uid").isNotNull() & (F.col("review_uid") != ""))
    order = F.struct("page_no", "block_pos")
    cols = ["author", "rating", "review_date_raw", "experience_date_raw", "review_text", "_h", "_t"]
    first = (rv.groupBy("review_uid").agg(F.min_by(F.struct(*cols), order).alias("_v"))
               .select("review_uid", "_v.*"))
    if materialize_first:      # reviews and responses both derive from it: extract once
        from ..session import materialize
        first = materialize(first)
    reviews = first.select("review_uid", "author", "rating", "review_date_raw", "experience_date_raw",
                           "review_text", F.lit(source).alias("source"))
    resp = first.select("review_uid", F.posexplode(F.arrays_zip(F.col("_h").alias("h"), F.col("_t").alias("t")))
                        .alias("pos", "r"))
    resp = resp.select("review_uid", (F.col("pos") + 1).alias("response_rank"),
                       _strip_tags(F.col("r.h")).alias("response_header_raw"),
                       _strip_tags(F.col("r.t")).alias("response_text_raw"))
    resp = resp.filter(F.col("response_header_raw").isNotNull() | F.col("response_text_raw").isNotNull())
    return reviews, resp


def extract_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Relative links of a page in first-seen order (dedupe by first position)."""
    links = pages.select(id_col, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(r'<a href="([^"]+)"'), 1))
                         .alias("pos", "href"))
    return (links.groupBy(id_col, "href").agg(F.min("pos").alias("first_pos"))
                 .withColumn("slug", F.lower(F.regexp_replace(F.col("href"), r"^/+|/+$", ""))))


def page_title(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    t = F.regexp_extract(F.col(html_col), r"(?s)<title>(.*?)</title>", 1)
    return pages.select(id_col, F.nullif(py_strip(html_unescape(t)), F.lit("")).alias("title"))
