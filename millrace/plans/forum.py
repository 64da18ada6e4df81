"""Activity of users on a question-and-answer site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.counting import having_duplicates


def users_active_posts(
    users: DataFrame,
    posts: DataFrame,
    comments: DataFrame,
    postlinks: DataFrame,
    link_keys: tuple[str, str] = ("id", "postid"),
) -> DataFrame:
    """Per user: own posts that have a comment and a link key listed more than once.

    The second of ``link_keys`` names the post. Comments and links are reduced to
    distinct post ids ahead of their semi-joins and posts to one count per owner
    ahead of the user join, so no much-commented post or busy owner is hot.
    """
    commented = comments.select(F.col("postid").alias("id")).distinct()
    linked = having_duplicates(postlinks, list(link_keys))
    linked = linked.select(F.col(link_keys[1]).alias("id")).distinct()
    per_owner = (
        posts.join(commented, "id", "left_semi")
        .join(linked, "id", "left_semi")
        .groupBy(F.col("owneruserid").alias("id"))
        .agg(F.count(F.lit(1)).alias("n_own"))
    )
    return (
        users.select("id").join(per_owner, "id").groupBy("id").agg(F.sum("n_own").alias("n_posts"))
    )
