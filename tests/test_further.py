from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lateline.operators import ranks, selection, supply
from lateline.schema import TARGET
from lateline.sources import csv, profile


def brute_plan(rows):
    """Moves by two pointers over the sites of each item."""
    net = {}
    for item, site, units in rows:
        net[(item, site)] = net.get((item, site), 0) + (units or 0)
    out = []
    for item in {i for i, _ in net}:
        own = sorted(((s is None, s or "", u) for (i, s), u in net.items() if i == item and u))
        give, take = ([[None if n else s, abs(u)] for n, s, u in own if (u > 0) == side] for side in (True, False))
        while give and take:
            moved = min(give[0][1], take[0][1])
            out.append((item, give[0][0], take[0][0], moved))
            for line in (give, take):
                line[0][1] -= moved
                if not line[0][1]:
                    line.pop(0)
    return out


@pytest.mark.parametrize("window", [100_000, 7])
def test_transfer_plan_moves_every_unit_once(spark, monkeypatch, window):
    monkeypatch.setattr(ranks, "WINDOW_ROWS", window)
    rng = random.Random(window)
    rows = [(rng.choice(["x", "y", None]), f"s{k}" if k % 9 else None, rng.randint(-20, 20)) for k in range(120)]
    rows += [("z", "a", 10 ** 9), ("z", "b", -10 ** 9 - 5), ("q", "a", 4), ("q", "b", None), ("w", "a", 3), ("w", "a", -3)]
    got = supply.transfer_plan(spark.createDataFrame(rows, "item string, site string, units int"), ["item"], "site", "units")
    assert got.columns == ["item", "from_site", "to_site", "units"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute_plan(rows)))
    none = spark.createDataFrame([], "item string, site string, units int")
    assert supply.transfer_plan(none, ["item"], "site", "units").collect() == []
    alone = supply.transfer_plan(spark.createDataFrame([("a", 2), ("b", -1)], "site string, units int"), [], "site", "units")
    assert [tuple(r) for r in alone.collect()] == [("a", "b", 1)]


def test_fair_balance_shares_add_up(spark):
    rng = random.Random(4)
    stock = [(rng.choice("xy"), f"s{rng.randint(0, 9)}", rng.randint(0, 50)) for _ in range(60)] + [("z", "a", 7)]
    demand = [(rng.choice("xy"), f"s{rng.randint(0, 9)}", rng.randint(0, 9)) for _ in range(40)]
    frames = [spark.createDataFrame(r, "item string, site string, n int") for r in (stock, demand)]
    got = supply.fair_balance(*frames, ["item"], "site", "n", "n").collect()
    for item in "xy":
        own = [r for r in got if r.item == item]
        held, asked = sum(r.stock for r in own), sum(r.demand for r in own)
        assert sum(r.units for r in own) == 0 and held == sum(n for i, _, n in stock if i == item)
        assert all(abs(r.stock - r.units - held * r.demand / asked) < 1 for r in own)
    assert not [r for r in got if r.item == "z"]


def test_mixed_files_are_read_each_in_its_own_form(spark, tmp_path):
    folder = tmp_path / "a b+c.csv"
    folder.mkdir()
    (folder / "1 x.csv").write_bytes('Order Id,Customer Fname,"a;b;c;d"\n1,"é, x",1\n2,y,2\n'.encode())
    (folder / "2.csv").write_bytes('Order Id;Customer Fname;größe\n3;"é; ""q"" x";1.5\n4;ü,ü,ü;2\n'.encode("latin-1"))
    (folder / "3.csv").write_bytes("Customer Fname\tOrder Id\nz\t5\n".encode())
    (folder / "4.csv").write_bytes('Order Id|Customer Fname\n6|"two\nlines"\n'.encode("utf-8-sig"))
    found = {r["file"][-5:]: r["delimiter"] for r in csv.detect_delimiters(spark, str(folder)).collect()}
    assert found == {"x.csv": ",", "2.csv"[-5:]: ";", "3.csv"[-5:]: "\t", "4.csv"[-5:]: "|"}
    files = csv.inspect_files(spark, str(folder))
    assert [f.encoding for f in files] == ["UTF-8", "ISO-8859-1", "UTF-8", "UTF-8"]
    assert [f.broken for f in files] == [False, False, False, True]
    got = csv.read_csv(spark, str(folder), delimiter=None)
    assert got.columns == ["Order Id", "Customer Fname", "a;b;c;d", "größe"]
    rows = {r["Order Id"]: tuple(r)[1:] for r in got.collect()}
    assert rows == {1: ("é, x", 1, None), 2: ("y", 2, None), 3: ('é; "q" x', None, 1.5), 4: ("ü,ü,ü", None, 2.0),
                    5: ("z", None, None), 6: ("two\nlines", None, None)}


def test_delimiter_is_the_steadiest_and_not_the_commonest(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("id;a, b, c, d, e\n" + "".join(f"{k};{', '.join('x' * (k % 7))}\n" for k in range(40)))
    (tmp_path / "one.csv").write_text("only\n1\n2\n")
    assert [r["delimiter"] for r in csv.detect_delimiters(spark, str(path)).collect()] == [";"]
    assert [r["delimiter"] for r in csv.detect_delimiters(spark, str(tmp_path / "one.csv")).collect()] == [","]
    assert csv.read_csv(spark, str(path), delimiter=None).count() == 40


def psi(x):
    out = 0.0
    while x < 30:
        out -= 1 / x
        x += 1
    f = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f / 240)))


def brute_information(x, y, neighbours):
    labels, counts = np.unique(y, return_counts=True)
    inside = np.isin(y, labels[counts > 1])
    x, y, total = x[inside], y[inside], 0.0
    for value, label in zip(x, y):
        own = np.sort(np.abs(x[y == label] - value))
        k = min(neighbours, len(own) - 1)
        radius = own[k]
        near = (x == value).sum() if radius == 0 else ((x > value - radius) & (x < value + radius)).sum()
        total += psi(k) - psi(len(own)) - psi(near)
    return max(0.0, psi(len(x)) + total / len(x))


@pytest.mark.parametrize("window, neighbours", [(100_000, 3), (40, 3), (100_000, 1)])
def test_neighbour_information_matches_brute_force(spark, monkeypatch, window, neighbours):
    monkeypatch.setattr(ranks, "WINDOW_ROWS", window)
    rng = np.random.default_rng(window + neighbours)
    y = rng.integers(0, 2, 250)
    tables = {"shifted": rng.normal(size=250) + 2 * y, "noise": rng.normal(size=250), "tied": np.round(rng.normal(size=250) + y, 1),
              "flag": (rng.random(250) < 0.2 + 0.6 * y).astype(float), "same": np.full(250, 2.0)}
    y = np.append(y, [7, 8, 8])
    tables = {c: np.append(v, [1.5, 0.0, 0.0]) for c, v in tables.items()}
    rows = [tuple(float(v[i]) for v in tables.values()) + (int(y[i]),) for i in range(len(y))] + [(None, 1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in tables) + f", {TARGET} int").repartition(4)
    got = {r.feature: (r.mutual_info, r["rank"]) for r in selection.neighbour_information(df, neighbours).collect()}
    want = {c: brute_information(v, y, neighbours) for c, v in tables.items()}
    assert all(abs(got[c][0] - want[c]) < 1e-9 for c in tables)
    assert got["shifted"][1] == 1 and want["shifted"] > 0.2 and sorted(r for _, r in got.values()) == [1, 2, 3, 4, 5]


def test_memory_plan_counts_bytes(spark):
    rows = [(k % 3, k + 70_000, k * 0.5, 0.1 * k, "ab" if k % 2 else None, f"own {k}", None, k % 2 == 0) for k in range(1_000)]
    df = spark.createDataFrame(rows, "a int, b long, c double, d double, e string, `f g` string, h string, i boolean")
    got = {r["column"]: (r.plain_bytes, r.stored_as, r.narrow_bytes) for r in profile.memory_plan(df).collect()}
    own = sum(len(f"own {k}") for k in range(1_000))
    assert got == {
        "a": (4_000, "tinyint", 1_000), "b": (8_000, "int", 4_000), "c": (8_000, "float", 4_000), "d": (8_000, "double", 8_000),
        "e": (5_000, "dictionary", 1_006), "f g": (4_000 + own, "string", 4_000 + own), "h": (4_000, "string", 4_000),
        "i": (1_000, "boolean", 1_000)}
    total = profile.memory_summary(profile.memory_plan(df)).first()
    assert total["before_mb"] == round(sum(v[0] for v in got.values()) / 1e6, 2) and 0 < total["saved_percent"] < 100


def test_memory_plan_of_many_different_texts_stays_within_its_error(spark):
    df = spark.range(200_000).selectExpr("concat('value ', id % 60000) AS t")
    row = profile.memory_plan(df).first()
    length = sum(len(f"value {k}") for k in range(60_000)) / 60_000
    want = 200_000 * 2 + 60_000 * (4 + length)
    assert row["stored_as"] == "dictionary" and abs(row["narrow_bytes"] / want - 1) < 0.02


def test_profiles_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b string, c double")
    assert [r["narrow_bytes"] for r in profile.memory_plan(empty).collect()] == [0, 0, 0]
    assert profile.memory_plan(spark.createDataFrame([], "a array<int>")).first()["plain_bytes"] is None
