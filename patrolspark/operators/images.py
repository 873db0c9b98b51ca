"""Image store view: the latest content of each image id.

Images are appended as they arrive (never one small file per image); this
view keeps, per id, the content of the message latest in stream order
(``partition``, ``offset``).  Ids and positions alone decide which message that
is: their maximum is a mergeable aggregate, so an id sent a million times is
reduced map-side and no content is shuffled or sorted for it.  The contents of the
winners are then fetched by a semi join on id and position.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_images(images: DataFrame, id_col: str = "image_id", content: str | None = "content",
                  order: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """One row per id: the id and its latest content, or the whole row for ``content=None``.

    A position names one message; rows that share id and position are one message
    delivered twice, of which one stays.  Rows without an id are one group.
    """
    last = images.groupBy(id_col).agg(F.max(F.struct(*order)).alias("last"))
    last = last.select(F.col(id_col).alias("last_id"), "last")
    same = [F.col(id_col).eqNullSafe(F.col("last_id"))]
    same += [F.col(c).eqNullSafe(F.col("last")[c]) for c in order]
    found = images.join(last, reduce(lambda a, b: a & b, same), "left_semi")
    keep = found.columns if content is None else [id_col, content]
    return found.dropDuplicates([id_col, *order]).select(*keep)
