"""Displayed times against a row-at-a-time reading with the standard library."""

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from rosta.operators import instants
from rosta.operators.instants import resolve_instants
from rosta.plans.general import dated_rows

UTC = timezone.utc


def brute(text, captured, zone):
    """Milliseconds of a displayed time, or None; written apart from the operator."""
    if text is None:
        return None
    s = re.sub(r"[\s ]+", " ", text).strip().lower()
    if re.fullmatch(r"\d{10}", s):
        return int(s) * 1000
    if re.fullmatch(r"\d{13}", s):
        return int(s)
    tz = ZoneInfo(zone) if zone else None
    zones = instants.OFFSETS
    clock = r"(?:(de|du)\. )?(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d+))?)? ?(z|[+-]\d\d:?\d\d|[a-z]{3,4})?"
    ymd = None
    here = captured.replace(tzinfo=UTC).astimezone(tz) if captured and tz else None
    if m := re.fullmatch(r"(\d{4})[-./] ?(\d\d?)[-./] ?(\d\d?)\.?[ t]" + clock, s):
        ymd, rest = tuple(int(x) for x in m.groups()[:3]), m.groups()[3:]
    elif m := re.fullmatch(r"(\d{4})(\d\d)(\d\d)t(\d\d)(\d\d)(\d\d)(z|[+-]\d{4})?", s):
        g = m.groups()
        ymd, rest = tuple(int(x) for x in g[:3]), (None, g[3], g[4], g[5], None, g[6])
    elif m := re.fullmatch(r"\w+, (\d\d?) (\w+) (\d{4}) " + clock, s):
        ymd, rest = (int(m[3]), instants.MONTHS.get(m[2], 0), int(m[1])), m.groups()[3:]
    elif m := re.fullmatch(r"(\d{4})\.? (\w+)\.? (\d\d?)\.?,?(?: -)? " + clock, s):
        ymd, rest = (int(m[1]), instants.MONTHS.get(m[2], 0), int(m[3])), m.groups()[3:]
    elif m := re.fullmatch(r"(\d\d?)\.(\d\d?)\.(\d{4}) " + clock, s):
        ymd, rest = (int(m[3]), int(m[2]), int(m[1])), m.groups()[3:]
    elif (m := re.fullmatch(r"(\w+),? " + clock, s)) and m[1] in instants.RELATIVE and here:
        d = (here - timedelta(days=0)).date() - timedelta(days=instants.RELATIVE[m[1]])
        ymd, rest = (d.year, d.month, d.day), m.groups()[1:]
    elif (m := re.fullmatch(r"(\w+)\. (\d\d?)\. - " + clock, s)) and here:
        rest = m.groups()[2:]
        for year in range(here.year, here.year - 9, -1):
            try:
                if datetime(year, instants.MONTHS.get(m[1], 0), int(m[2]), int(rest[1]), int(rest[2]), int(rest[3] or 0)) <= here.replace(tzinfo=None):
                    ymd = (year, instants.MONTHS[m[1]], int(m[2]))
                    break
            except ValueError:
                pass
    if ymd is None:
        return None
    half, h, mi, sec, frac, zone_text = rest
    h = int(h)
    if half:
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if half == "du" else 0)
    try:
        wall = datetime(*ymd, h, int(mi), int(sec or 0), int((frac or "0").ljust(6, "0")[:6]))
    except ValueError:
        return None
    if zone_text:
        off = zones.get(zone_text)
        if off is None and zone_text[0] in "+-":
            d = zone_text.replace(":", "")
            off = (1 if d[0] == "+" else -1) * (int(d[1:3]) * 60 + int(d[3:]))
        if off is None:
            return None
        utc = wall.replace(tzinfo=UTC) - timedelta(minutes=off)
    else:
        if tz is None:
            return None
        utc = wall.replace(tzinfo=tz, fold=0).astimezone(UTC)
        if utc.astimezone(tz).replace(tzinfo=None) != wall:
            return None
    return (utc - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(milliseconds=1)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_tables_against_brute_force(spark, size):
    rows = dated_rows(spark, f"/root/testdata/{size}")
    got = {(r.src, r.row_id): r.utc_ms for r in resolve_instants(rows, ["src", "row_id"], ["src", "origin"], "row_id", "date", "scraped_at", "zone").collect()}
    want = {(r.src, r.row_id): brute(r.date, r.scraped_at, r.zone) for r in rows.collect()}
    assert len(got) == len(want)
    wrong = [(k, got[k], want[k]) for k in want if got[k] != want[k]]
    assert not wrong, wrong[:5]


def frame(spark, dates, zone="Europe/Budapest", captured="2024-05-10 10:00:00", more=""):
    df = spark.createDataFrame([(i, d, zone) for i, d in enumerate(dates)], "id bigint, date string, zone string")
    return df.withColumn("at", F.lit(captured).cast("timestamp_ntz"))


def resolved(df, **more):
    return [r.utc_ms for r in resolve_instants(df, ["id"], ["zone"], "id", "date", "at", "zone", **more).orderBy("id").collect()]


def test_edges(spark):
    cases = {
        "2023-10-29 02:30:00": datetime(2023, 10, 29, 0, 30),  # twice: the first
        "2023-03-26 02:30:00": None,  # skipped
        "2024-02-30 10:00": None,
        "0000-00-00 00:00:00": None,
        "29.02.2024 7:05": datetime(2024, 2, 29, 6, 5),
        "febr. 29. - 07:05:00": datetime(2024, 2, 29, 6, 5),
        "máj. 11. - 07:05:00": datetime(2023, 5, 11, 5, 5),
        "tegnapelőtt, 0:00": datetime(2024, 5, 7, 22, 0),
        "2024.01.02. du. 12:36": datetime(2024, 1, 2, 11, 36),
        "2024.01.02. de. 12:36": datetime(2024, 1, 1, 23, 36),
        "5 perce": None, "ma": None, "": None, "2024-01-02": None, "x" * 100_000: None, None: None,
    }
    want = [None if v is None else int(v.replace(tzinfo=UTC).timestamp() * 1000) for v in cases.values()]
    assert resolved(frame(spark, list(cases))) == want


def test_chain_decides_what_no_rule_decides(spark):
    days = ["13.01.2024 10:00", "02.03.2024 10:00", "04.03.2024 10:00", "25.03.2024 10:00"]
    assert resolved(frame(spark, days), day_first=None) == resolved(frame(spark, days), day_first=True)
    months = ["01.13.2024 10:00", "03.02.2024 10:00", "03.04.2024 10:00", "03.25.2024 10:00"]
    assert resolved(frame(spark, months), day_first=None) == resolved(frame(spark, months), day_first=False)
    # one stretch per few records gives what one stretch gives
    assert resolved(frame(spark, months), day_first=None, stretch=2, overlap=3) == resolved(frame(spark, months), day_first=None)


def test_nulls_repeats_clashes_and_empty(spark):
    df = frame(spark, ["2024-01-02 10:00"] * 2 + ["tegnap 10:00", "2024-01-02T10:00Z"])
    df = df.withColumn("zone", F.when(F.col("id") < 1, F.col("zone"))).withColumn("at", F.when(F.col("id") == 0, F.col("at")))
    df = df.withColumn("_order", F.lit("clash")).withColumn("utc_ms", F.lit(1)).withColumn("_k0", F.lit(2))
    t = int(datetime(2024, 1, 2, 9, tzinfo=UTC).timestamp() * 1000)
    assert resolved(df) == [t, None, None, t + 3_600_000]
    none = df.withColumn("id", F.lit(None).cast("bigint"))
    assert sorted(x or 0 for x in resolved(none)) == [0, 0, t, t + 3_600_000]
    out = resolve_instants(df.limit(0), ["id"], ["zone"], "id", "date", "at", "zone")
    assert out.columns == ["id", "utc_ms"] and out.count() == 0


def test_both_sides_of_a_clock_change(spark):
    night = ["29.10.2023 01:50", "29.10.2023 02:30", "29.10.2023 02:10", "29.10.2023 02:50", "29.10.2023 03:05"]
    first = [int(datetime(2023, 10, 28 + (h > 1), (h - 2) % 24, m, tzinfo=UTC).timestamp() * 1000) for h, m in ((1, 50), (2, 30), (2, 10), (2, 50))]
    got = resolved(frame(spark, night), first_side=None)
    # the second 2:10 lies after the first 2:30
    assert got[:2] == first[:2] and got[2:4] == [t + 3_600_000 for t in first[2:]] and got[4] == first[3] + 75 * 60_000
    assert resolved(frame(spark, night))[:4] == first
    lord_howe = frame(spark, ["2024-04-07 01:45:00"], zone="Australia/Lord_Howe")
    assert resolved(lord_howe, first_side=False)[0] - resolved(lord_howe)[0] == 1_800_000


def test_chain_is_the_cheapest_of_all(spark):
    """Against every combination of readings, on random runs of numeric dates."""
    import itertools
    import random

    from rosta.operators.instants import BACK_COST, SWITCH_COST, with_readings

    rng = random.Random(4)
    dates = [f"{rng.randrange(1, 14):02}.{rng.randrange(1, 14):02}.2024 10:00" for _ in range(9)]
    df = frame(spark, dates)
    lists = [r._readings for r in with_readings(df, F.col("date"), F.lit(0), F.col("zone"), None, None).orderBy("id").collect()]
    some = [i for i, x in enumerate(lists) if x]

    def cost(path):
        return sum(r.cost for r in path) + sum(SWITCH_COST * (a.shape != b.shape) + BACK_COST * (b.ms < a.ms) for a, b in zip(path, path[1:], strict=False))

    least = min(cost(path) for path in itertools.product(*[lists[i] for i in some]))
    got = resolved(df, day_first=None, first_side=None)
    chosen = [next(r for r in lists[i] if r.ms == got[i]) for i in some]
    assert any(len(x) > 1 for x in lists) and cost(chosen) == least


def test_only_open_stretches_move(spark):
    df = frame(spark, ["2024-01-02 10:00"] * 30 + ["02.03.2024 10:00"] + ["2024-01-02 10:00"] * 30).withColumn("id", F.col("id") * 100)
    assert "Exchange" not in resolve_instants(df, ["id"], ["zone"], "id", "date", "at", "zone")._jdf.queryExecution().toString()
    whole = resolved(df, day_first=None)
    assert whole == resolved(df, day_first=True) == resolved(df, day_first=None, stretch=256, overlap=100)


def test_chain_against_the_rule_on_a_table(spark):
    """Where the tables' rule says which reading holds, the chain without the rule finds it for most open records."""
    from rosta.plans.general import p3_chained, p3_instants

    folder = "/root/testdata/sf0.01"
    ruled, chained = ({(r.src, r.row_id): r.utc_ms for r in q(spark, folder).collect()} for q in (p3_instants, p3_chained))
    assert ruled.keys() == chained.keys()
    decided = [k for k in ruled if ruled[k] is not None]
    same = sum(ruled[k] == chained[k] for k in decided)
    assert same >= 0.97 * len(decided)


def test_p3_found_comes_through_the_chain(spark):
    """The readings that the rules exclude are in the chain, most stretches are open, and what comes out is what the rules say."""
    from rosta.operators.instants import RULED_OUT, with_readings
    from rosta.plans.general import p3_found

    folder = "/root/testdata/sf0.01"
    found = p3_found(spark, folder)
    assert "FlatMapGroupsInArrow" in found._jdf.queryExecution().toString()
    rows = dated_rows(spark, folder).collect()
    want = {(r.src, r.row_id, ms) for r in rows if (ms := brute(r.date, r.scraped_at, r.zone)) is not None}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want
    df = frame(spark, ["02.03.2024 10:00", "2024-02-03 10:00", "29.10.2023 02:30", "01.13.2024 10:00", "25.03.2024 10:00", "2024-02-30 10:00"])
    costs = [[x.cost for x in r._readings] for r in with_readings(df, F.col("date"), F.lit(0), F.col("zone"), pruned=False).orderBy("id").collect()]
    assert costs == [[0.0, RULED_OUT], [0.0, RULED_OUT], [0.0, RULED_OUT], [RULED_OUT], [0.0], []]


def test_no_neighbours_outweigh_a_rule(spark):
    """All neighbours speak for what the rule excludes; values with excluded readings only fix no instant; cuts do not matter."""
    months = ["01.13.2024 10:00", "01.14.2024 10:00", "02.01.2024 10:00", "01.15.2024 10:00", "01.16.2024 10:00", "2024-13-01 10:00", "2023-10-29 02:30", "2023-10-29 02:10"]
    df = frame(spark, months)
    utc = lambda *at: int(datetime(*at, tzinfo=UTC).timestamp() * 1000)
    sides = [utc(2023, 10, 29, 0, 30), utc(2023, 10, 29, 0, 10)]
    want = [None, None, utc(2024, 1, 2, 9), None, None, None, *sides]
    assert resolved(df, pruned=False) == want == resolved(df)
    assert resolved(df, pruned=False, stretch=2, overlap=1) == want
    assert resolved(df, pruned=False, day_first=False, first_side=False) == resolved(df, day_first=False, first_side=False)
    unordered = df.withColumn("at_row", F.lit(None).cast("bigint"))
    got = resolve_instants(unordered, ["id"], ["zone"], "at_row", "date", "at", "zone", pruned=False).orderBy("id").collect()
    assert [r.utc_ms for r in got] == want
    empty = resolve_instants(df.limit(0), ["id"], ["zone"], "id", "date", "at", "zone", pruned=False)
    assert empty.columns == ["id", "utc_ms"] and empty.count() == 0
