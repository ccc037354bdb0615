"""Enrich interactions with their track id and keep only known tracks and users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import fallback


def clean_interactions(interactions: DataFrame, tracks: DataFrame, users: DataFrame,
                       msid_col: str = "recording_msid", mbid_col: str = "recording_mbid",
                       user_col: str = "user_id") -> DataFrame:
    """Inner-join interactions to tracks (on the listen's msid) and to users.

    Output: the interaction columns with ``recording_msid`` renamed to
    ``interactions_msid``, plus ``recording_mbid`` taken from the track, or the
    track's msid when the track has no mbid. Unknown tracks/users and null keys
    drop out (inner joins); duplicate keys in a dimension multiply rows.

    Only the key and mbid columns of the dimensions are read (column pruning
    reaches the scan). The planner broadcasts a dimension when its estimated or
    measured size is under the broadcast threshold and otherwise sort-merge joins
    with AQE splitting hot keys.
    """
    inter = interactions.withColumnRenamed(msid_col, "interactions_msid")
    trk = tracks.select(F.col(msid_col).alias("_cz_tracks_msid"), F.col(mbid_col).alias("_cz_mbid"))
    usr = users.select(F.col(user_col).alias("_cz_users_user_id"))

    joined = inter.join(trk, inter["interactions_msid"] == trk["_cz_tracks_msid"], "inner")
    # one id leaves for the shuffle by user, not both of the track
    known = joined.select(
        *[F.col(c) for c in inter.columns],
        fallback("_cz_mbid", "_cz_tracks_msid").alias(mbid_col),
    )
    return known.join(usr, known[user_col] == usr["_cz_users_user_id"], "inner").drop("_cz_users_user_id")
