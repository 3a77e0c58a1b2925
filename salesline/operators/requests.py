"""Rules for forecast requests, applied to a whole table of them at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesline.functions.parsing import request_timestamp, scrub

# The keys of a point that are not extras.
POINT_KEYS = ("date", "value", "extras")

REQUEST_SCHEMA = "id string, series array<map<string,string>>"
NO_POINTS, TOO_MANY, NO_VALUES = "no_points", "too_many_points", "no_values"


def explode_requests(requests: DataFrame) -> DataFrame:
    """One row per point: ``id, pos, date, value, extras``; a request without points keeps one null row."""
    point = F.col("_p")
    rows = requests.select("id", F.posexplode_outer("series").alias("pos", "_p"))
    given = F.coalesce(F.from_json(point["extras"], "map<string,string>"), F.create_map().cast("map<string,string>"))
    others = F.map_filter(point, lambda k, _: ~k.isin(*POINT_KEYS))
    merged = F.map_concat(F.map_filter(given, lambda k, _: ~F.array_contains(F.map_keys(others), k)), others)
    return rows.select(
        "id",
        "pos",
        request_timestamp(point["date"]).alias("date"),
        scrub(point["value"].try_cast("double")).alias("value"),
        F.when(F.size(merged) > 0, merged).alias("extras"),
    )


def split_extras(df: DataFrame, json_col: str, known: tuple[str, ...] = POINT_KEYS) -> DataFrame:
    """Keys of a JSON object that are not known, as a map."""
    keys = F.from_json(F.col(json_col), "map<string,string>")
    return df.withColumn("extras", F.map_filter(keys, lambda k, _: ~k.isin(*known)))


def keep_last_points(points: DataFrame, id_col: str = "id", date: str = "date", pos: str = "pos") -> DataFrame:
    """One point per request and date: the one given last."""
    rest = [c for c in points.columns if c not in (id_col, date)]
    last = points.groupBy(id_col, date).agg(F.max_by(F.struct(*rest), pos).alias("_p"))
    return last.select(id_col, date, *[F.col(f"_p.{c}").alias(c) for c in rest])


def request_status(
    points: DataFrame, id_col: str = "id", date: str = "date", value: str = "value", max_points: int | None = None
) -> DataFrame:
    """``ok`` or the reason a request is refused; ``max_points`` sets a limit to its points."""
    n = F.count_if(F.col(date).isNotNull() | F.col(value).isNotNull())
    status = F.when(n == 0, NO_POINTS)
    if max_points:
        status = status.when(n > max_points, TOO_MANY)
    status = status.when(F.count(value) == 0, NO_VALUES).otherwise("ok")
    return points.groupBy(id_col).agg(n.alias("points"), F.count(value).alias("known"), status.alias("status"))


def valid_points(points: DataFrame, id_col: str = "id", **kwargs) -> DataFrame:
    """Points of accepted requests, one per date."""
    good = request_status(points, id_col, **kwargs).where("status = 'ok'").select(id_col)
    return keep_last_points(points.join(good, id_col, "left_semi"), id_col)
