"""Requests as named parameters of SQL: values are bound, never part of the text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# Defaults and bounds of a request.
PAGE, SIZE, LIMIT, MOST = 1, 25, 20, 100


class BadRequest(ValueError):
    """A parameter is not what it has to be."""


def whole(params: dict[str, str], name: str, default: int, most: int | None = None) -> int:
    """A positive whole number; the default where it is not given."""
    raw = params.get(name)
    if raw is None:
        return default
    try:
        value = float(raw)
    except ValueError:
        raise BadRequest(f"{name} is no number") from None
    if value != value or value != int(value) or value < 1 or (most is not None and value > most):
        raise BadRequest(f"{name} has to be a whole number from 1" + (f" to {most}" if most else ""))
    return int(value)


def listed(params: dict[str, str], name: str) -> list[str]:
    """A list written with commas; empty where it is not given."""
    return params[name].split(",") if params.get(name) else []


def one_of(params: dict[str, str], name: str, allowed: tuple[str, ...], default: str) -> str:
    value = params.get(name, default)
    if value not in allowed:
        raise BadRequest(f"{name} has to be one of {', '.join(allowed)}")
    return value


@dataclass(frozen=True)
class PageRequest:
    """What a page of properties is asked for: see `read`."""

    search: str
    cities: list[str]
    statuses: list[str]
    sort: str
    descending: bool
    page: int
    size: int

    @classmethod
    def read(cls, params: dict[str, str], sortable: tuple[str, ...]) -> PageRequest:
        """From texts by name (search, city, status, sort, dir, page, pageSize); unknown names are ignored."""
        sort = params.get("sort") or sortable[0]
        if sort not in sortable:
            raise BadRequest(f"sort has to be one of {', '.join(sortable)}")
        descending = one_of(params, "dir", ("asc", "desc"), "asc") == "desc"
        return cls(params.get("search") or "", listed(params, "city"), listed(params, "status"), sort, descending, whole(params, "page", PAGE), whole(params, "pageSize", SIZE, MOST))


def property_page(properties: DataFrame, params: dict[str, str], sortable: tuple[str, ...] = ("id", "name", "city", "status")) -> DataFrame:
    """A page of properties (id, name, city, status, ...) in the order asked for, nulls last, ties by id, with the number of all in `total`.

    The request's texts are parameters of the statement; only the name of the column to sort by, one of sortable, is part of it.
    """
    asked = PageRequest.read(params, sortable)
    words = ("DESC" if asked.descending else "ASC") + " NULLS LAST"
    text = f"""WITH kept AS (SELECT * FROM {{rows}} WHERE (:search = '' OR contains(lower(name), lower(:search)))
      AND (size(:cities) = 0 OR array_contains(:cities, city)) AND (size(:statuses) = 0 OR array_contains(:statuses, status)))
    SELECT kept.*, (SELECT count(*) FROM kept) AS total FROM kept ORDER BY `{asked.sort}` {words}, id LIMIT :size OFFSET :skip"""
    spark = properties.sparkSession
    texts = lambda xs: "array(" + ", ".join(f":{n}" for n in xs) + ")" if xs else "cast(array() as array<string>)"
    cities, statuses = ({f"{name}{i}": x for i, x in enumerate(xs)} for name, xs in (("city", asked.cities), ("status", asked.statuses)))
    text = text.replace(":cities", texts(cities)).replace(":statuses", texts(statuses))
    return spark.sql(text, args={"search": asked.search, "size": asked.size, "skip": (asked.page - 1) * asked.size} | cities | statuses, rows=properties)
