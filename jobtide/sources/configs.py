"""Per-user filter settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.skew import salted_join
from jobtide.functions.text import literal_list
from jobtide.schemas import CONFIG_LISTS, USER_CONFIG
from jobtide.vocab import DEFAULT_CONFIG


def _defaulted(cfg: Column) -> list[Column]:
    out = []
    for name in CONFIG_LISTS:
        default = literal_list(DEFAULT_CONFIG.get(name, []))
        out.append(F.coalesce(cfg[name], default).alias(name))
    for name in ("salary_min", "tolerance"):
        out.append(F.coalesce(cfg[name], F.lit(DEFAULT_CONFIG[name])).alias(name))
    return out


def load_configs(stores: DataFrame) -> DataFrame:
    """One row per user over the defaults. A present but empty list is kept."""
    return raw_configs(stores).select("chat_id", *_defaulted(F.col("cfg")))


def raw_configs(stores: DataFrame) -> DataFrame:
    """JSON stores {chat_id: config} (column `value`) -> (chat_id, cfg), as users have set it.

    Users whose entry is no object are skipped; a store that is a single flat config, or no
    object at all, holds no users.
    """
    entries = stores.select(F.from_json("value", "map<string,string>").alias("m"))
    is_flat = (F.coalesce(F.map_contains_key("m", "tolerance"), F.lit(False))
               | F.coalesce(F.map_contains_key("m", "seniorities"), F.lit(False)))
    return (entries.where(~is_flat)
            .select(F.explode("m").alias("chat_id", "body"))
            .where(F.ltrim("body").startswith("{"))
            .select("chat_id", F.from_json("body", USER_CONFIG).alias("cfg")))


def edit_list(edits: DataFrame) -> DataFrame:
    """Replay add and remove actions on a user's list: (chat_id, seq, action, value).

    Values are compared without case. A value added while present keeps its first spelling and
    place, so each value stands where the first addition after its last removal put it. A
    'clear' action (value null) empties the list.
    """
    key = ["chat_id", "_v"]
    marked = edits.withColumn("_v", F.lower("value"))
    cleared = (marked.where("action = 'clear'").groupBy("chat_id")
               .agg(F.max("seq").alias("_cleared")))
    gone = (marked.where("action = 'remove'").groupBy(*key).agg(F.max("seq").alias("_gone")))
    adds = marked.where("action = 'add'")
    adds = salted_join(adds, gone, key, F.col("seq"), "left")
    adds = salted_join(adds, cleared, ["chat_id"], F.col("seq"), "left")
    live = adds.where(F.col("seq") > F.greatest(F.coalesce("_gone", F.lit(-1)),
                                                F.coalesce("_cleared", F.lit(-1))))
    return (live.groupBy(*key).agg(F.min_by("value", "seq").alias("value"),
                                   F.min("seq").alias("seq"))
            .select("chat_id", "value", "seq"))
