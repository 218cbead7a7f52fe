"""Random messy tables against plain Python loops over the rows."""

import math
import random
from collections import Counter, defaultdict

import pytest
from plumbline import (
    clean,
    CleanSpec,
    column_counts,
    duplicate_row_groups,
    duplicate_rows,
    health_snapshot,
    issues_log,
    keep_first,
)
from plumbline.functions.text import STRIP_CHARS

SCHEMA = "row_id long, k string, n int, v double, s string, t string"
RULES = {
    "v": {"min": -1, "max": 10.5},
    "s": {"allowed": ["Red", " green", "ÉCRU", "x" * 80]},
    "n": {"min": 2, "allowed": [1, 2, 3, 4, 5, 6]},
    "t": {"max": 3, "allowed": ["1", "2", "4", "abc"]},
    "absent": {"min": 0},
}
CAP = 7


def make_rows(seed):
    rng = random.Random(seed)
    pads = ["", "", "", " ", "  ", "\t", "\xa0", "\u2003", "\x1f", "\n", "\u3000", "\x85"]
    words = ["Red", "red", "RED", "Green", "green", "Blue", "écru", "Écru", "ÉCRU", "x" * 80, "X" * 80, "", "日本", "😀"]
    texts = ["1", "2", "4", "3.5", "abc", "Abc", "1e1", "0x2", "7d", "", "-2", "Inf", "nan"]
    hot = rng.choice([None, "hot", "Q" * 100])

    def maybe(value, p=0.12):
        return None if rng.random() < p else value

    rows = []
    for i in range(rng.choice([1, 40, 300])):
        if rows and rng.random() < 0.15:
            rows.append((i, *rng.choice(rows)[1:]))
            continue
        key = hot if rng.random() < 0.33 else maybe("k%d" % rng.randrange(150))
        v = maybe(rng.choice([rng.uniform(-5, 15), float("nan"), -1.0, 10.5, float("inf"), -0.0, 0.0]))
        s = maybe(rng.choice(pads) + rng.choice(words) + rng.choice(pads))
        t = maybe(rng.choice(["", " ", "\t"]) + rng.choice(texts) + rng.choice(["", " "]))
        rows.append((i, key, maybe(rng.randrange(9)), v, s, t))
    rng.shuffle(rows)
    return rows


def missing(value):
    return value is None or (isinstance(value, float) and math.isnan(value))


def number(value):
    if missing(value):
        return None
    if isinstance(value, str):
        text = value.strip().lower()
        if text.endswith(("d", "f")) and "inf" not in text or text.startswith(("0x", "-0x")):
            return None
        try:
            value = float(text)
        except ValueError:
            return None
    return None if isinstance(value, float) and math.isnan(value) else value


def out_of_range(value, rule):
    x = number(value)
    return x is not None and (("min" in rule and x < rule["min"]) or ("max" in rule and x > rule["max"]))


def unlisted(value, rule):
    if "allowed" not in rule or missing(value):
        return False
    return str(value).strip().lower() not in {str(a).strip().lower() for a in rule["allowed"]}


def plain(value):
    return None if missing(value) else (value + 0.0 if isinstance(value, float) else value)


def expected_counts(rows):
    counts = {}
    for j, name in enumerate(["k", "n", "v", "s", "t"], start=1):
        column = [r[j] for r in rows]
        rule = RULES.get(name, {})
        formatting = 0
        if name in "kst":
            casings = defaultdict(set)
            for value in column:
                if value is not None:
                    casings[value.strip().lower()].add(value.strip())
            formatting = sum(
                value is not None and (value != value.strip() or len(casings[value.strip().lower()]) > 1)
                for value in column
            )
        counts[name] = (
            len(rows),
            sum(map(missing, column)),
            sum(out_of_range(x, rule) or unlisted(x, rule) for x in column),
            len(rows) - len(set(column)) if name == "k" else 0,
            formatting,
        )
    return counts


def expected_issues(rows, cap=CAP):
    rows = sorted(rows)
    names = ["k", "n", "v", "s", "t"]
    log = []
    for j, name in enumerate(names, start=1):
        log += [(r[0], name, "missing_value") for r in rows if missing(r[j])][:cap]
    times = Counter(r[1] for r in rows)
    log += [(r[0], "k", "duplicate_key") for r in rows if times[r[1]] > 1][:cap]
    for name, rule in RULES.items():
        if name in names:
            j = names.index(name) + 1
            log += [(r[0], name, "invalid_value") for r in rows if out_of_range(r[j], rule)][:cap]
    return log


def expected_first(rows):
    first = {}
    for r in sorted(rows):
        first.setdefault(r[1], r[0])
    return set(first.values())


@pytest.mark.parametrize("seed", range(8))
def test_against_loops(spark, seed):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(1 + seed)
    got = {tuple(r)[1]: tuple(r)[2:] for r in column_counts(df, "k", RULES, "row_id").collect()}
    assert got == expected_counts(rows)

    assert [tuple(r) for r in issues_log(df, "row_id", "k", RULES, cap=CAP).collect()] == expected_issues(rows)

    distinct = Counter(tuple(plain(x) for x in r[1:]) for r in rows)
    assert duplicate_rows(df, "row_id").first().duplicate_rows == len(rows) - len(distinct)
    groups = duplicate_row_groups(df.drop("row_id")).collect()
    assert {tuple(plain(x) for x in r[:-1]): r.dup_count for r in groups} == {
        row: n for row, n in distinct.items() if n > 1
    }
    assert {r.row_id for r in keep_first(df, "k", "row_id").collect()} == expected_first(rows)
    whole = [tuple(r) for r in issues_log(df, "row_id", "k", RULES).collect()]
    assert sorted(whole) == sorted(expected_issues(rows, None))

    ranges = {"v": RULES["v"], "n": {"min": 2}}
    snapshot = tuple(health_snapshot(df, "k", ranges, ["v", "s"]).first())
    assert snapshot == (
        len(rows),
        sum(n > 1 for n in Counter(r[1] for r in rows).values()),
        sum(out_of_range(r[3], RULES["v"]) or out_of_range(r[2], {"min": 2}) for r in rows),
        sum(missing(r[3]) or missing(r[4]) for r in rows),
    )

    spec = CleanSpec(key="k", trim=["s"], sentence=["t"], flag_ranges=ranges, drop=["n"])
    by_id = {r[0]: r for r in rows}
    cleaned = clean(df, spec, "row_id").collect()
    assert {r.row_id for r in cleaned} == expected_first(rows)
    for r in cleaned:
        _, k, n, v, s, t = by_id[r.row_id]
        assert (r.k, r.s) == (k, None if s is None else s.strip(" "))
        assert r.t == (None if t is None else t.strip(" ")[:1].upper() + t.strip(" ")[1:].lower())
        assert r.is_flagged_invalid == int(out_of_range(v, RULES["v"]) or out_of_range(n, {"min": 2}))


def test_strip_characters():
    assert len(STRIP_CHARS) == len(set(STRIP_CHARS)) == 29
    assert all(c.isspace() for c in STRIP_CHARS)
