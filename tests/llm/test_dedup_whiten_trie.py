"""Exact dedup, whitening and the conversation trie against plain Python and
DuckDB."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tests.llm.fixtures import LOWER, SF, WORD, edge_rows, table

from knnrec.llm import exact_dedup, forest, prefix_trie, queries, whitening
from knnrec.llm.common import hot_join, stage
from knnrec.llm.oracle import ORACLES


def as_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def duck(name, **tables):
    con = duckdb.connect()
    for t, rows in tables.items():
        con.register(t, rows) if not isinstance(rows, str) else con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{rows}'")
    out = con.execute(ORACLES[name])
    cols = [d[0] for d in out.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in out.fetchall()), key=repr)


@pytest.mark.parametrize("name, tables", [("op12_exact_dedup", ["documents"]), ("op13_conversation_trie", ["conversations"])])
def test_queries_equal_sql(spark, name, tables):
    want = duck(name, **{t: f"{SF}/{t}.parquet" for t in tables})
    assert as_rows(queries.QUERIES[name](spark, SF)) == want and len(want) > 300


# ---------------------------------------------------------------- exact dedup


def dedup_rows():
    rng = random.Random(4)
    hot = "One text that a third of all rows hold"
    rows = [(k, rng.choice([hot, hot.upper(), hot.lower()]), "en", "s", 1) for k in range(400)]
    rows += [(1000 + k, f"text {k % 90}", "en", "s", 1) for k in range(700)]
    rows += [(5, hot, "en", "s", 1), (5, hot, "de", "t", 2), (None, hot, "en", "s", 1), (None, "only without id", "en", "s", 1)]
    rows += [(None, "only without id", None, None, None), (3000, "É", "fr", "s", 1), (3001, "é", "fr", "s", 1), (3002, "ÉA", "fr", "s", 1), (3003, "Éa", "fr", "s", 1)]
    return rows + [(5000 if r[0] is None else 4000 + r[0], *r[1:]) for r in edge_rows()]


def brute_dedup(rows):
    groups = defaultdict(list)
    for k, (doc_id, text, *_) in enumerate(rows):
        groups[(text or "").translate(LOWER)].append((doc_id is not None, doc_id or 0, k))
    out = []
    for text, held in groups.items():
        keep = max(held)
        for has, doc_id, k in held:
            sha = hashlib.sha256(text.encode()).hexdigest()
            out.append((doc_id if has else None, len(held), keep[1] if keep[0] else None, k == keep[2], sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("heavy", [1000, 4])
def test_dedup_equals_brute_force(spark, monkeypatch, heavy):
    """With ``heavy`` 4 one text is split off and the others are shuffled."""
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    rows = dedup_rows()
    docs = table(spark, rows, clash=True).repartition(5)
    found = exact_dedup.mark(docs)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = brute_dedup(rows)
    assert as_rows(found) == want
    stay = exact_dedup.keep_last(docs)
    assert stay.columns == docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in stay.collect()))) == sorted(repr(w[0]) for w in want if w[3])
    assert exact_dedup.mark(table(spark, [])).count() == 0 == exact_dedup.keep_last(table(spark, [])).count()


def test_heavy_digests_are_verified(spark):
    """Only texts above the share are broadcast, with exact counts."""
    rows = [(k, "hot" if k % 3 == 0 else f"t{k}", "en", "s", 1) for k in range(9000)]
    named = exact_dedup.F.monotonically_increasing_id().alias("tie")
    marked = table(spark, rows).select("doc_id", exact_dedup.digest(exact_dedup.F.col("text")).alias("digest"), named)
    heavy = exact_dedup.heavy_digests(stage(marked, "t")).collect()
    assert [(bytes(r["digest"]), r["group_size"], r["winner"]["doc_id"]) for r in heavy] == [(hashlib.sha256(b"hot").digest(), 3000, 8997)]


def test_dedup_plan_is_native(spark):
    plan = exact_dedup.mark(table(spark, dedup_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ whitening


VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows(seed=2, n=300, d=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    rows = [(k, [float(np.float32(c)) for c in base[k % 200]], 1) for k in range(n)]  # a third are copies
    return rows + [(7, rows[7][1], None), (None, rows[8][1], 2), *((900 + k, rows[0][1], 0) for k in range(150))]


def brute_whiten(rows, weights, k=8):
    usable = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v, *_ in rows]
    fit = [x for _, x in usable] if weights == "count" else [list(t) for t in {tuple(x) for _, x in usable}]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    v = np.cov(np.array(fit, dtype=float).T, bias=True)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = defaultdict(list)
    for i, x in usable:
        far = [n * a - s for a, s in zip(x, sums, strict=True)]
        out[i].append((sum(f * f for f in far), np.array(far) / n @ u / np.sqrt(e)))
    return n, out, e / np.trace(v)


@pytest.mark.parametrize("weights", ["count", "one"])
def test_whitening_equals_numpy(spark, weights):
    rows = vector_rows()
    junk = [(1, None, 1), (2, [], 1), (3, [1.0, None, 0.0, 0.0, 0.0], 1), (4, [float("nan")] * 5, 1), (5, [float("inf")] * 5, 1), (6, [1.0, 2.0], 1), (8, [1e30] * 5, 1)]
    clash = [whitening.F.lit(0).alias(c) for c in ["key", "w", "x", "copies", "z", "n", "far", "component", "deviation"]]
    df = spark.createDataFrame(rows + junk, VECTORS).select("*", *clash)
    n, want, explained = brute_whiten(rows, weights)
    got = defaultdict(lambda: defaultdict(list))
    for r in whitening.whiten(df, weights=weights).collect():
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        got[r["component"]][r["vec_id"]].append((int(r["deviation"]), r["whitened"]))
    assert sorted(got) == [1, 2, 3, 4, 5]
    for component, found in got.items():
        signs = Counter()
        assert found.keys() == want.keys()
        for i, values in found.items():
            assert [d for d, _ in values] == [d for d, _ in want[i]]
            for (_, z), (_, y) in zip(values, want[i], strict=True):
                assert abs(abs(z) - abs(y[component - 1])) < 1e-8
                signs[z * y[component - 1] > 0] += abs(z) > 1e-6
        assert 0 in (signs[True], signs[False])


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(k, [0.5, 0.25], 0) for k in range(9)], VECTORS)
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], VECTORS)).count() == 0
    line = spark.createDataFrame([(k, [k / 8, k / 4], 0) for k in range(9)], VECTORS)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}
    with pytest.raises(ValueError, match="weights"):
        whitening.whiten(same, weights="none")


def test_deviations_beyond_64_bits_are_exact():
    x = np.array([[9 * 10**15, -5], [3, 4]])
    sums = [9 * 10**15 + 3, -1]
    d = whitening.deviations(x, 10**6, sums)
    want = [[a * 10**6 - s for a, s in zip(r, sums, strict=True)] for r in x.tolist()]
    assert d.tolist() == want and whitening.squared_length(d) == [sum(v * v for v in r) for r in want]


def test_query_on_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF)
    assert dict(got.dtypes)["deviation"] == "bigint"
    n, want, _ = brute_whiten([(r["vec_id"], r["embedding"]) for r in rows], "count")
    found = got.collect()
    assert len(found) == 8 * len(rows) and {r["n"] for r in found} == {n}
    for r in found:
        far, z = want[r["vec_id"]][0]
        assert r["deviation"] == far and abs(abs(r["whitened"]) - abs(z[r["component"] - 1])) < 1e-8


# ----------------------------------------------------------------------- trie


TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    own, sequences = defaultdict(list), {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    turns = {c: [t[3:] for t in sorted(held)] for c, held in own.items()}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        sequences[c] = turns.get(int(c - math.fmod(c, 20)), [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, held in members.items():
        words = len(WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(held) - 1) * words
    out = []
    for k, held in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in held if len(sequences[c]) == len(k)))
        sha = hashlib.sha256(ends.encode()).hexdigest()
        parent = min(members[k[:-1]]) if k else None
        out.append((min(held), len(k), sha, children[k], len(held), leaves[k], parent, saved[k]))
    return sorted(out, key=repr)  # columns by name, as as_rows has them


def turn_rows(seed=1):
    """Shared beginnings, copies, one conversation with a third of all turns,
    negative ids, missing bases, nulls, ties and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 130), *range(-25, -1), 997, 10**12, 10**12 + 7]:
        n = rng.choice([1, 2, 3, 5, 9])
        first = rng.randrange(3)
        rows += [(c, t, "user" if t % 2 else "system", f"hello {first if t < 2 else rng.randrange(3)} there") for t in range(n)]
    rows += [(44, t, "user", f"turn {t % 7} of a long conversation") for t in range(10, 400)]
    rows += [(c, t, "user", f"copy {t}") for c in range(2000, 2030) for t in range(4)]
    rows += [(50, None, None, None), (50, None, "user", None), (50, 0, None, ""), (51, 1, "user", "tie a"), (51, 1, "user", "tie b")]
    return rows + [(51, 1, "user", "tie a"), (None, 0, "user", "no conversation"), (52, 3, "user", "x \t\n y " * 3000), (53, 9, "é:", ":")]


@pytest.mark.parametrize("local", [1, 12, 50_000])
def test_trie_equals_brute_force(spark, local):
    rows = turn_rows()
    clash = [prefix_trie.F.lit(0).alias(c) for c in ["conv", "a", "b", "d", "i", "u", "n", "h", "m", "wt", "digest", "words"]]
    df = spark.createDataFrame(rows, TURNS).select("*", *clash).repartition(7)
    assert as_rows(prefix_trie.trie(df, local=local)) == brute_trie(rows)


def test_trie_in_small_blocks_and_hot_keys(spark, monkeypatch):
    """Long conversations over several windows, segments and id blocks."""
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 2)
    monkeypatch.setattr(prefix_trie, "ID_BITS", 1)
    monkeypatch.setattr(forest, "CHUNK", 5)
    monkeypatch.setattr(forest, "segment", lambda d: forest.F.shiftright(d, 2))
    monkeypatch.setattr("knnrec.llm.common.ARROW_ROWS", 0)
    rows = turn_rows(3)
    assert as_rows(prefix_trie.trie(spark.createDataFrame(rows, TURNS).repartition(5), local=30)) == brute_trie(rows)


def test_trie_of_oracle_rows_with_edges(spark):
    rows = turn_rows(5)
    import pandas as pd

    frame = pd.DataFrame({"conv_id": pd.array([r[0] for r in rows], "Int64"), "turn": pd.array([r[1] for r in rows], "Int64"), "role": [r[2] for r in rows], "text": [r[3] for r in rows]})
    assert duck("op13_conversation_trie", conversations=frame) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "a")], TURNS)).count() == 0


def test_local_decomposition_adds_up():
    rng = random.Random(7)
    for n in [1, 2, 3, 50, 400]:
        for shape in ("random", "path", "star"):
            parent = [-1] + [{"random": rng.randrange(i), "path": i - 1, "star": 0}[shape] for i in range(1, n)]
            values = [[rng.randrange(10) for _ in range(n)], [1] * n]
            want = [list(v) for v in values]
            for i in range(n - 1, 0, -1):
                for w in want:
                    w[parent[i]] += w[i]
            got = [[0] * n, [0] * n]
            depth = [0] * n
            for i in range(1, n):
                depth[i] = depth[parent[i]] + 1
            forest.split_component(sorted(range(n), key=lambda i: depth[i]), parent, values, got)
            assert got == want


def test_hot_join_equals_join(spark, monkeypatch):
    monkeypatch.setattr("knnrec.llm.common.ARROW_ROWS", 0)
    rows = stage(spark.createDataFrame([(7 if k % 3 else k, k) for k in range(900)], "k long, v long"), "t")
    facts = spark.createDataFrame([(k, k * k) for k in range(0, 900, 2)] + [(7, 49)], "k long, f long")
    for how in ("inner", "left"):
        plain = as_rows(rows.join(facts, ["k"], how))
        assert as_rows(hot_join(rows, facts, ["k"], how, parts=10)) == plain
