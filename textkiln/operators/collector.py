"""The two collectors as one path each: categories -> titles -> requested
batches -> landed extracts -> cleaning -> framed texts.

Both return ``(title_pos, batch, title, text, framed)`` with one row per
distinct title that has a usable extract: titles are numbered in code-point
order over all categories and requested in batches of 20, and of several
extracts of a title the last usable one counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.operators import categories as K
from textkiln.operators import corpus as C


def _texts(titles: DataFrame, extracts: DataFrame, batch_size: int) -> DataFrame:
    asked = K.distinct_titles(titles).withColumn("batch", F.floor(F.col("title_pos") / batch_size).cast("long"))
    found = C.frame(C.join_titles(asked, C.last_per_title(extracts)))
    return found.select("title_pos", "batch", "title", "text", "framed")


def collect_newer(seeds: DataFrame, members: DataFrame, extracts: DataFrame, batch_size: int = K.BATCH_SIZE, **limits) -> DataFrame:
    """Articles of the seed categories and, within ``limits``, of their
    subcategories; reference sections are cut and blank texts dropped.
    Malformed responses (``error`` set) lose their own row only."""
    good = extracts.where(F.col("error").isNull())
    return _texts(K.walk(seeds, members, **limits).titles(), C.clean_extracts(good), batch_size)


def collect_older(seeds: DataFrame, members: DataFrame, extracts: DataFrame, batch_size: int = K.BATCH_SIZE,
                  limit: int = K.MAX_PAGES_PER_CATEGORY) -> DataFrame:
    """Articles of the seed categories alone (namespace 0); texts stay whole
    and only the empty string is dropped."""
    mine = members.join(seeds.select("cat").distinct(), "cat", "left_semi")
    titles = K.read_members(mine, limit, namespaces=K.NAMESPACES_OLDER).where("kept").select("cat", "title")
    good = extracts.where(F.col("error").isNull()).withColumn("text", F.col("extract"))
    return _texts(titles, good.where(C.keep_nonempty_older("text")), batch_size)
