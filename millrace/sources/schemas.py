"""Declared schemas.

Fixed values: column names, order and types of the input files.
"""

from __future__ import annotations

FORUM_TABLES = {
    "badges": "id bigint, class bigint, date timestamp, name string, tagbased boolean, userid bigint",
    "comments": (
        "id bigint, creationdate timestamp, postid bigint, score bigint, text string, "
        "userdisplayname string, userid bigint"
    ),
    "postlinks": (
        "id bigint, creationdate timestamp, linktypeid boolean, postid bigint, relatedpostid bigint"
    ),
    "posts": (
        "id bigint, acceptedanswerid bigint, answercount bigint, body string, closeddate string, "
        "commentcount bigint, communityowneddate timestamp, creationdate timestamp, "
        "favoritecount bigint, lastactivitydate timestamp, lasteditdate timestamp, "
        "lasteditordisplayname string, lasteditoruserid bigint, ownerdisplayname string, "
        "owneruserid bigint, parentid bigint, posttypeid bigint, score bigint, tags string, "
        "title string, viewcount bigint"
    ),
    "users": (
        "id bigint, aboutme string, accountid bigint, creationdate timestamp, displayname string, "
        "downvotes bigint, lastaccessdate timestamp, location string, profileimageurl string, "
        "reputation bigint, upvotes bigint, views bigint, websiteurl string"
    ),
    "votes": (
        "id bigint, bountyamount string, creationdate timestamp, postid bigint, userid string, "
        "votetypeid bigint"
    ),
}

COUNTRY_STATISTICS = (
    "country_name string, official_name_en string, iso_3166_2 string, iso_3166_3 string, "
    "region_name string, sub_region_name string, developed boolean, age_median double, "
    "youth_unempl_rate double, above_average_median_age string, above_average_yu string"
)

POPULATION = "country_code string, population_2020 bigint"
