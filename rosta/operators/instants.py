"""Displayed times of many shapes to unambiguous instants.

Every value is expanded, inside the JVM, into an array of all its valid interpretations (shape, instant, cost): both orders of day and
month, both sides of a clock change. A Viterbi pass over each source's record order then chooses one interpretation per record; it
penalises a change of shape and a jump back in time. A stated rule (the day comes first, the first of two equal wall clock times) is a cost
that no chain can make up for: what it excludes is chosen only for a value that has nothing else, and then fixes no instant. Stretches in which
some record has several interpretations are shuffled and chained. On request, interpretations that cost so much more than another of the same
value that the chain could not prefer them are dropped before it, which leaves fewer stretches to shuffle and the same choice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosta.session import written

DAY_MS = 86_400_000

# Month names as the sites show them, by month number (English, Hungarian, German and Russian).
MONTHS = {
    "jan": 1, "január": 1, "january": 1,
    "feb": 2, "febr": 2, "február": 2, "february": 2,
    "mar": 3, "márc": 3, "március": 3, "march": 3,
    "apr": 4, "ápr": 4, "április": 4, "april": 4,
    "may": 5, "máj": 5, "május": 5,
    "jun": 6, "jún": 6, "június": 6, "june": 6,
    "jul": 7, "júl": 7, "július": 7, "july": 7,
    "aug": 8, "augusztus": 8, "august": 8,
    "sep": 9, "sept": 9, "szept": 9, "szeptember": 9, "september": 9,
    "oct": 10, "okt": 10, "október": 10, "october": 10,
    "nov": 11, "november": 11,
    "dec": 12, "december": 12,
    "januar": 1, "jänner": 1, "februar": 2, "märz": 3, "mär": 3, "mai": 5, "juni": 6, "juli": 7, "oktober": 10, "dez": 12, "dezember": 12,
    "янв": 1, "января": 1, "фев": 2, "февраля": 2, "мар": 3, "марта": 3, "апр": 4, "апреля": 4, "мая": 5, "июн": 6, "июня": 6, "июл": 7, "июля": 7, "авг": 8, "августа": 8, "сен": 9, "сент": 9, "сентября": 9, "окт": 10, "октября": 10, "ноя": 11, "ноября": 11, "дек": 12, "декабря": 12,
}

# Offsets in minutes of the zone abbreviations that name one offset.
OFFSETS = {"z": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 60, "west": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180}

# Days counted back from the day of capture.
RELATIVE = {"ma": 0, "tegnap": 1, "tegnapelőtt": 2, "today": 0, "yesterday": 1, "heute": 0, "gestern": 1, "vorgestern": 2, "сегодня": 0, "вчера": 1, "позавчера": 2}

_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"(?:\s*(z|[+-]\d{2}:?\d{2}|[a-z]{3,4}))?"
_NAME = r"(\p{L}{3,10})"


@dataclass(frozen=True)
class Shape:
    """A pattern over the trimmed lower-cased value and where its parts stand in it.

    fields: the template that rewrites a match to ``year|month|day|half|hour|minute|second|fraction|zone|word``.
    """

    name: str
    pattern: str
    fields: str


def shapes() -> list[Shape]:
    """All shapes, of which a value matches one at most; those of numbers have a second reading with day and month exchanged."""
    return [
        Shape("ymd", rf"(\d{{4}})([-./])\s?(\d{{1,2}})\2\s?(\d{{1,2}})\.?,?(?:\s+|t)(?:(de|du|am|pm)\.?\s*)?{_CLOCK}{_ZONE}", "$1|$3|$4|$5|$6|$7|$8|$9|$10|"),
        Shape("compact", r"(\d{4})(\d{2})(\d{2})t?(\d{2})(\d{2})(\d{2})?" + _ZONE, "$1|$2|$3||$4|$5|$6||$7|"),
        Shape("rfc", rf"(?:\p{{L}}{{2,10}},?\s+)?(\d{{1,2}})\.?\s+{_NAME}\.?\s+(\d{{4}}),?\s+{_CLOCK}{_ZONE}", "$3|$2|$1||$4|$5|$6|$7|$8|"),
        Shape("named", rf"(\d{{4}})\.?\s+{_NAME}\.?\s+(\d{{1,2}})[.,\s-]+{_CLOCK}{_ZONE}", "$1|$2|$3||$4|$5|$6|$7|$8|"),
        Shape("us", rf"{_NAME}\.?\s+(\d{{1,2}}),?\s+(\d{{4}}),?\s+{_CLOCK}{_ZONE}", "$3|$1|$2||$4|$5|$6|$7|$8|"),
        Shape("yearless", rf"{_NAME}\.?\s+(\d{{1,2}})[.,\s-]+{_CLOCK}", "-|$1|$2||$3|$4|$5|$6||"),
        Shape("numeric", rf"(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{4}})\.?,?\s+{_CLOCK}{_ZONE}", "$3|$2|$1||$4|$5|$6|$7|$8|"),
        Shape("relative", rf"(\p{{L}}{{2,12}}),?\s+{_CLOCK}", "*||||$2|$3|$4|$5||$1"),
    ]


#: Penalties of the chain, the most that a choice can save in it (both neighbours' switch and jump), and the cost of what a stated rule excludes.
SWITCH_COST, BACK_COST = 1.0, 1.0
MOST_SAVED = 2 * (SWITCH_COST + BACK_COST)
RULED_OUT = 4 * MOST_SAVED


def _lookup(key: Column, table: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def _admitted(reading: Column) -> Column:
    """Whether no stated rule excludes the reading."""
    return reading["cost"] < RULED_OUT


def _days(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970-01-01 of a date, null where there is no such date."""
    safe = F.make_date(year, F.when(month.between(1, 12), month).otherwise(F.lit(1)), F.lit(1))
    real = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31) & (day <= F.dayofmonth(F.last_day(safe)))
    return F.when(real, F.unix_date(safe) + day - 1)


def _to_utc(local_ms: Column, zone: Column) -> Column:
    """Wall clock to instant: the first of two, null for one that the clocks skipped."""
    wall = F.timestamp_millis(local_ms)
    utc = F.to_utc_timestamp(wall, zone)
    return F.when(F.from_utc_timestamp(utc, zone) == wall, F.unix_millis(utc))


def _second(ms: Column, local_ms: Column, zone: Column) -> Column:
    """The second instant with the same wall clock, an hour or half an hour after the first; null where there is one only."""
    wall = F.timestamp_millis(local_ms)
    later = [F.when(F.from_utc_timestamp(F.timestamp_millis(ms + step), zone) == wall, ms + step) for step in (3_600_000, 1_800_000)]
    return F.coalesce(*later)


def with_readings(df: DataFrame, date: Column, captured_ms: Column, zone: Column, day_first: bool | None = True, first_side: bool | None = True, pruned: bool = True) -> DataFrame:
    """``df`` with ``_readings``: the readings of ``date`` as array<struct<shape int, ms bigint, cost double>>, those that no rule excludes first.

    date: the displayed text; null, empty, vague ages, impossible dates and dates without time of day give an empty array.
    captured_ms: capture time in milliseconds UTC, for relative and yearless dates; zone: the site's time zone name.
    A numeric date that ends with the year has two readings, with the day and with the month first, and a wall clock time that occurs
    twice has two instants. ``day_first`` and ``first_side`` (True or False) state which one holds, and the other costs ``RULED_OUT``; None
    leaves both open at no cost, the day and the first side preferred in ties. A date that begins with the year has a second reading with the day
    before the month, which costs ``RULED_OUT``, too. With ``pruned`` only those of a value's readings stay that cost at most ``MOST_SAVED``
    more than its cheapest and that no rule excludes: those that a chain can choose and that fix an instant.
    The steps are separate projections, so that each value is computed once.
    """
    plans = shapes()
    df = df.withColumns({"_text": F.lower(F.trim(F.regexp_replace(date, r"[\s\u00a0]+", " "))), "_zone": zone, "_here": F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(captured_ms), zone))})
    text = F.col("_text")
    rewritten = [F.when(text.rlike(f"^(?:{s.pattern})$"), F.concat(F.lit(f"{s.name}|"), F.regexp_replace(text, f"^(?:{s.pattern})$", s.fields))) for s in plans]
    df = df.withColumn("_f", F.split(F.coalesce(F.when(text.rlike(r"^\d{10}(\d{3})?$"), F.lit("epoch|")), *rewritten), r"\|"))
    part = lambda n: F.get("_f", F.lit(n + 1))
    number = lambda n: part(n).try_cast("int")  # noqa: E731 - the patterns admit digits or nothing there
    df = df.withColumns(
        {
            "_shape": F.get("_f", F.lit(0)),
            "_year": number(0),
            "_month": F.coalesce(number(1), _lookup(part(1), MONTHS)),
            "_day": number(2),
            "_half": part(3),
            "_hour": number(4),
            "_minute": number(5),
            "_second": F.coalesce(number(6), F.lit(0)),
            "_milli": F.coalesce(F.rpad(F.substring(part(7), 1, 3), 3, "0").try_cast("int"), F.lit(0)),
            "_offset": part(8),
            "_back": _lookup(part(9), RELATIVE),
            "_here_day": F.floor(F.col("_here") / DAY_MS).cast("int"),
        }
    )
    half, hour, minute, second, offset = (F.col(f"_{n}") for n in ("half", "hour", "minute", "second", "offset"))
    clock24 = F.when(half.isin("du", "pm", "de", "am"), F.when(hour.between(1, 12), hour % 12 + F.when(half.isin("du", "pm"), 12).otherwise(0))).when(hour.between(0, 23), hour)
    of_day = F.when(minute.between(0, 59) & second.between(0, 59), ((clock24.cast("long") * 60 + minute) * 60 + second) * 1000 + F.col("_milli"))
    digits = F.regexp_replace(offset, "[^0-9]", "")
    minutes = F.when(offset == "", None).when(offset.rlike("^[+-]"), F.when(offset.startswith("-"), -1).otherwise(1) * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int"))).otherwise(_lookup(offset, OFFSETS))
    df = df.withColumns({"_of_day": of_day, "_minutes": minutes, "_here_date": F.date_from_unix_date("_here_day")})
    # a date without year is the latest one not after the capture; 29 February goes back to the last leap year
    rank = lambda month, day, ms: (month * 32 + day).cast("long") * DAY_MS + ms
    here_rank = rank(F.month("_here_date"), F.dayofmonth("_here_date"), F.col("_here") - F.col("_here_day").cast("long") * DAY_MS)
    last = F.year("_here_date") - F.when(rank(F.col("_month"), F.col("_day"), F.col("_of_day")) <= here_rank, 0).otherwise(1)
    df = df.withColumn("_last", last)
    leap = F.col("_last") - F.col("_last") % 4
    leap = leap - F.when((leap % 100 == 0) & (leap % 400 != 0), 4).otherwise(0)
    leap_day = (F.col("_month") == 2) & (F.col("_day") == 29)
    df = df.withColumn("_year", F.when(F.col("_shape") == "yearless", F.when(leap_day, leap).otherwise(F.col("_last"))).otherwise(F.col("_year")))
    month, day = F.col("_month"), F.col("_day")
    numeric, turned = F.col("_shape") == "numeric", F.col("_shape").isin("numeric", "ymd")
    df = df.withColumns(
        {
            "_date1": F.when(F.col("_shape") == "relative", F.col("_here_day") - F.col("_back")).otherwise(_days(F.col("_year"), month, day)),
            "_date2": F.when(turned & (month != day), _days(F.col("_year"), day, month)),
        }
    )
    names = ["epoch", *[s.name for s in plans]]
    shape_no = F.array_position(F.array(*map(F.lit, names)), F.col("_shape")).cast("int")
    stamp = F.when(F.col("_shape") == "epoch", F.col("_text").try_cast("long") * F.when(F.length("_text") == 10, 1000).otherwise(1))
    df = df.withColumns({f"_local{k}": F.col(f"_date{k}").cast("long") * DAY_MS + F.col("_of_day") for k in (1, 2)})
    fixed = lambda k: F.col(f"_local{k}") - F.col("_minutes").cast("long") * 60_000
    df = df.withColumns({"_ms1": F.coalesce(stamp, F.when(offset != "", fixed(1)).otherwise(_to_utc(F.col("_local1"), F.col("_zone")))), "_ms2": F.when(offset != "", fixed(2)).otherwise(_to_utc(F.col("_local2"), F.col("_zone")))})
    wall = (F.coalesce(offset, F.lit("")) == "") & (F.col("_shape") != "epoch")
    df = df.withColumns({f"_late{k}": F.when(wall, _second(F.col(f"_ms{k}"), F.col(f"_local{k}"), F.col("_zone"))) for k in (1, 2)})
    price = lambda stated, wanted: 0.0 if stated is None or stated == wanted else RULED_OUT
    order = {1: F.when(numeric, price(day_first, True)).otherwise(0.0), 2: F.when(numeric, price(day_first, False)).otherwise(RULED_OUT)}
    side = {"ms": price(first_side, True), "late": price(first_side, False)}
    # another reading of a value is another shape: its neighbours tell which one its source shows
    readings = [
        F.struct((shape_no + (k - 1) * len(names)).alias("shape"), F.col(f"_{which}{k}").alias("ms"), (order[k] + F.when(F.col(f"_late{k}").isNotNull(), side[which]).otherwise(0.0)).alias("cost"))
        for k in (1, 2)
        for which in ("ms", "late")
    ]
    df = df.withColumn("_all", F.filter(F.array(*readings), lambda r: r["ms"].isNotNull()))
    if not pruned:
        return df.withColumn("_readings", F.concat(F.filter("_all", _admitted), F.filter("_all", lambda r: ~_admitted(r))))
    cheapest = F.array_min(F.transform("_all", lambda r: r["cost"]))
    kept = F.filter("_all", lambda r: r["cost"] <= cheapest + MOST_SAVED)
    return df.withColumn("_readings", F.filter(kept, _admitted))


def _milliseconds(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970 UTC of a timestamp column; one without zone means UTC, whatever the session's zone is."""
    if dict(df.dtypes)[name] == "timestamp_ntz":
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    return F.unix_millis(F.col(f"`{name}`"))


def viterbi(shape: list[np.ndarray], ms: list[np.ndarray], cost: list[np.ndarray]) -> list[int]:
    """Cheapest choice per record of a chain whose records all have readings; ties take the earlier reading of the list."""
    total, back = cost[0].astype(float), []
    for i in range(1, len(shape)):
        step = SWITCH_COST * (shape[i - 1][:, None] != shape[i][None, :]) + BACK_COST * (ms[i][None, :] < ms[i - 1][:, None])
        paths = total[:, None] + step
        best = paths.argmin(axis=0)
        back.append(best)
        total = paths[best, np.arange(len(best))] + cost[i]
    at, out = int(total.argmin()), []
    for best in reversed(back):
        out.append(at)
        at = int(best[at])
    return [at, *reversed(out)]


def _choose(table):  # noqa: ANN001, ANN202 - pyarrow tables
    """One stretch of one source: rows in record order to (keys..., utc_ms)."""
    import pyarrow as pa

    table = table.sort_by([("_order", "ascending"), ("_tie", "ascending")])
    lists = table.column("_readings").combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    offsets = lists.offsets.to_numpy()
    flat = lists.values
    shape, ms, cost = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("shape", "ms", "cost"))
    size = np.diff(offsets)
    picked = np.where(size > 0, offsets[:-1], -1)
    have = np.flatnonzero(size > 0)  # records without reading take no part in the chain
    open_at = np.flatnonzero(size[have] > 1)
    k = 0
    while k < len(open_at):  # a run of open records between two that have one reading each
        first = last = open_at[k]
        while k + 1 < len(open_at) and open_at[k + 1] == last + 1:
            k += 1
            last = open_at[k]
        k += 1
        run = have[max(0, first - 1) : last + 2]
        cuts = [slice(offsets[i], offsets[i + 1]) for i in run]
        for i, choice in zip(run, viterbi([shape[c] for c in cuts], [ms[c] for c in cuts], [cost[c] for c in cuts]), strict=True):
            picked[i] = offsets[i] + choice
    chosen = np.maximum(picked, 0)
    none = (picked < 0) | (cost[chosen] >= RULED_OUT) if len(ms) else picked < 0  # a value with excluded readings only fixes no instant
    value = pa.array(np.where(none, 0, ms[chosen] if len(ms) else 0), pa.int64(), mask=none)
    keep = table.column("_own").to_numpy(zero_copy_only=False).astype(bool)
    return table.drop_columns(["_order", "_tie", "_readings", "_own"]).append_column("utc_ms", value).filter(pa.array(keep))


def resolve_instants(
    df: DataFrame,
    keys: list[str],
    source: list[str],
    order: str,
    date: str,
    captured: str,
    zone: str,
    day_first: bool | None = True,
    first_side: bool | None = True,
    stretch: int = 8192,
    overlap: int = 512,
    pruned: bool = True,
) -> DataFrame:
    """``keys`` and ``utc_ms`` for every row of ``df``: the chosen instant in milliseconds UTC, or null.

    The chain of a source runs over its records in the order of ``order`` (an integer column) and is cut into stretches of
    ``stretch`` order values, each of which also sees the ``overlap`` values before and after it, so that no source, however
    large its share of all rows, meets in one task. Two records with one reading each separate the chain exactly; the cut can
    differ from the uncut chain only inside a run of open records longer than ``overlap``. Only stretches that hold an open record are
    shuffled. ``pruned`` drops before the chain what it could not choose; where both rules are stated, no record is open then, whatever its
    value, and no row moves. Without it the chain chooses among all readings; where both rules are stated, it cannot differ from the uncut one,
    as a reading that no rule excludes costs less than another of the same value, whatever its neighbours are.

    Nulls: a null, empty or unreadable date gives null; a null zone gives null for wall clock times; a null capture time gives
    null for relative and yearless dates; rows with a null order are read one by one (the cheapest first reading). Repeated rows
    give repeated results. An empty table gives an empty table. Further columns of any name are ignored.
    """
    col = lambda n: F.col(f"`{n}`")
    names, by = [f"_k{i}" for i in range(len(keys))], [f"_s{i}" for i in range(len(source))]
    base = df.select(*[col(k).alias(n) for k, n in zip(keys, names, strict=True)], *[col(s).alias(n) for s, n in zip(source, by, strict=True)], col(order).cast("long").alias("_order"), col(date).alias("_date"), _milliseconds(df, captured).alias("_captured"), col(zone).alias("_z"))
    base = with_readings(base, F.col("_date"), F.col("_captured"), F.col("_z"), day_first, first_side, pruned)
    named = lambda d: d.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "utc_ms")
    # the reading is generated, not projected: a condition on it would else be pushed down, and with it all that it is made of
    single = lambda d: d.select(*names, F.explode_outer(F.slice("_readings", 1, 1)).alias("_one")).select(*names, F.when(_admitted(F.col("_one")), F.col("_one.ms")).alias("utc_ms"))
    if pruned and day_first is not None and first_side is not None:
        return named(single(base))
    base = written(base.withColumn("_tie", F.xxhash64("_date")).select(*names, *by, "_order", "_tie", "_readings"), "readings")
    block = F.floor(F.col("_order") / stretch)
    near = F.array(block, F.floor((F.col("_order") - overlap) / stretch), F.floor((F.col("_order") + overlap) / stretch))
    # a null source is one of its own: a struct compares it as a value
    base = base.withColumn("_of", F.struct(*[F.coalesce(F.col(s).cast("string"), F.lit("\0")).alias(s) for s in by])).withColumn("_home", block)
    spread = base.filter("_order is not null").withColumn("_block", F.explode(F.array_distinct(near))).withColumn("_own", F.col("_block") == F.col("_home"))
    open_blocks = spread.filter(F.size("_readings") > 1).select("_of", "_block").distinct()
    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    schema = ", ".join(f"`{n}` {types[n]}" for n in names) + ", utc_ms bigint"
    chained = spread.join(open_blocks, ["_of", "_block"], "left_semi").select(*names, "_of", "_block", "_order", "_tie", "_readings", "_own").groupBy("_of", "_block").applyInArrow(_stretch(names), schema)
    alone = single(base.join(open_blocks.withColumnRenamed("_block", "_home"), ["_of", "_home"], "left_anti"))
    return named(chained.unionByName(alone))


def _stretch(names: list[str]):  # noqa: ANN202
    return lambda table: _choose(table.select([*names, "_order", "_tie", "_readings", "_own"]))
