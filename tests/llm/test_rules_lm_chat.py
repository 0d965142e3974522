import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.fixtures import LOWER, SF, WORD, crc, edge_rows, prose, table

from knnrec.llm import chat, lm_hpy, quality_rules, queries

# -------------------------------------------------------------------- rules


def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    times = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + j for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    base = (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered))
    n, chars = len(w), base[1]
    measured = (1000 * symbols // max(chars, 1), 1000 * base[3] // max(len(lines), 1), 1000 * len(covered) // max(n, 1), 100 * chars // max(n, 1))
    return base, n < 50 or 100 * len(covered) > 50 * n, measured


def value_of(v):
    shift = max(v.bit_length() - 5, 0)
    return v >> shift << shift


def brute_judge(rows, min_rows):
    facts = [(r[0], r[2], r[3], *brute_measures(r[1])) for r in rows]

    def fences(group):
        out = []
        for m, (slack, low) in enumerate(quality_rules.RULES.values()):
            values = sorted(value_of(f[5][m]) for f in group)
            q25, q50, q75 = (values[-(-len(values) * q // 100) - 1] for q in (25, 50, 75))
            out.append((q75 + 3 * (q75 - q50) + slack, q25 - 3 * (q50 - q25) - slack if low else -1))
        return out

    found = []
    for f in facts:
        verdict = not f[4]
        own = [g for g in facts if g[3][0] and g[1:3] == f[1:3]]
        for group in (own, [g for g in facts if g[3][0] and g[1] == f[1]], [g for g in facts if g[3][0]]):
            if len(group) >= min_rows or len(group) == sum(g[3][0] > 0 for g in facts):
                break
        if own:
            verdict &= all(lo <= v <= hi for v, (hi, lo) in zip(f[5], fences(group), strict=True))
        found.append((f[0], *f[3], f[4], verdict))
    return found


def rule_rows():
    rng = random.Random(4)
    rows = edge_rows()
    for k in range(120):
        text = ".\n".join(prose(rng, 12) for _ in range(10))
        if k % 10 == 0:
            text = text.replace(" ", " ### ")
        if k % 10 == 1:
            text = "\n".join([text.split("\n")[0]] * 8) + "\n" + text
        if k % 10 == 2:
            text = text.replace("w", "wwwwwwwwwwwwwwwwwwwwwwwwww")
        rows.append((1000 + k, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None]), len(text)))
    return rows


def test_rules_equal_brute_force(spark):
    rows = rule_rows()
    got = quality_rules.judge(table(spark, rows, clash=True), min_rows=20).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = brute_judge(rows, 20)
    assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == sorted(want, key=repr)
    assert any(not w[-1] and not w[-2] for w in want)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 1 << 40))
def test_bucket_width(v):
    assert value_of(v) <= v <= value_of(v) * 17 / 16


def test_buckets_in_spark(spark):
    from pyspark.sql import functions as F

    values = [0, 1, 31, 32, 33, 63, 64, 1000, 12345, 10**9]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = df.select(quality_rules.bucket_value(quality_rules.bucket(F.col("v"))).alias("x")).collect()
    assert [r["x"] for r in got] == [value_of(v) for v in values]


def test_rules_are_native_and_empty_table(spark, capsys):
    out = quality_rules.judge(table(spark, rule_rows()))
    out.explain()
    quality_rules.measures(table(spark, rule_rows())).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
    assert quality_rules.judge(table(spark, [])).count() == 0


# ----------------------------------------------------------- language model


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def check_lm(spark, rows, got):
    train = Counter()
    for doc_id, text, *_ in rows:
        if crc(doc_id, 7) != 2:
            train.update(tokens(text))
    n, v = sum(train.values()), len(train)
    want = []
    for doc_id, text, *_ in rows:
        w = tokens(text)
        base = sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)
        want.append((doc_id, crc(doc_id, 7) == 2, len(w), sum(x in train for x in w), n, round(base, 4)))
    out = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got]
    assert sorted(out, key=repr) == sorted(want, key=repr)
    assert all(np.isfinite(r["score"]) and r["score"] <= 1e-9 for r in got)


def test_language_model_counts_and_edges(spark):
    rows = edge_rows()
    check_lm(spark, rows, lm_hpy.score(table(spark, rows, clash=True)).collect())
    assert lm_hpy.score(table(spark, [])).count() == 0
    only_held = [r for r in rows if crc(r[0], 7) == 2]
    got = lm_hpy.score(table(spark, only_held)).collect()
    assert len(got) == len(only_held) and all(r["score"] == 0 and r["base_score"] == 0 for r in got)


def test_small_chunks_give_the_same_counts(spark, monkeypatch):
    monkeypatch.setattr(lm_hpy, "CHUNK_BYTES", 1)
    rows = edge_rows()
    check_lm(spark, rows, lm_hpy.score(table(spark, rows).repartition(3)).collect())


def test_language_model_beats_the_base(spark):
    got = [r for r in queries.op8_lm_scoring(spark, SF).collect() if r["held_out"]]
    n = sum(r["n_tokens"] for r in got)
    assert sum(r["score"] for r in got) / n > sum(r["base_score"] for r in got) / n + 0.02
    again = {r["doc_id"]: r["score"] for r in queries.op8_lm_scoring(spark, SF).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 0.02 * abs(r["score"]) for r in got)


def test_scores_do_not_depend_on_how_rows_are_dealt(spark):
    """8 against 13 and 61 partitions: the same draws, row by row."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    before, scores = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (8, 13, 61):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            scores.append({r["doc_id"]: r["score"] for r in lm_hpy.score(docs.repartition(n)).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for other in scores[1:]:
        assert other.keys() == scores[0].keys()
        assert all(abs(other[k] - v) < 1e-6 * abs(v) for k, v in scores[0].items())


def test_row_streams_are_uniform_and_gamma():
    rng = lm_hpy.RowRandom(np.arange(100_000, dtype=np.uint64), 3)
    u = rng.random(100_000)
    assert abs(u.mean() - 0.5) < 0.01 and abs(u.var() - 1 / 12) < 0.002 and 0 < u.min() and u.max() < 1
    for shape in (0.1, 1.0, 40.0):
        g = rng.gamma(np.full(100_000, shape))
        assert abs(g.mean() / shape - 1) < 0.03 and abs(g.var() / shape - 1) < 0.05
    # a row's numbers are its own
    part = np.arange(500, 900)
    a, b = (lm_hpy.RowRandom(np.arange(n, dtype=np.uint64) + k, 9) for n, k in ((1000, 0), (400, 500)))
    assert (a.gamma(np.full(1000, 2.5))[part] == b.gamma(np.full(400, 2.5))).all()
    c, w = np.full(1000, 700), np.full(1000, 4.0)
    assert (lm_hpy.draw_tables(c, w, 0.6, a)[part] == lm_hpy.draw_tables(c[part], w[part], 0.6, b)).all()


def test_contexts_are_the_previous_words(spark):
    """Each of 200 words is followed by one of its own: held-out texts of the
    chain are foreseen, the same words in another order are not."""
    rng = random.Random(2)
    follows = list(range(200))
    rng.shuffle(follows)

    def chain(n):
        out = [rng.randrange(200)]
        while len(out) < n:
            out.append(follows[out[-1]])
        return out

    rows = [(k, " ".join(f"w{x}" for x in chain(40)), "en", "s", 1) for k in range(600)]
    odd = next(k for k in range(10_000, 20_000) if crc(k, 7) == 2)
    rows.append((odd, " ".join(f"w{x}" for x in rng.choices(range(200), k=400)), "en", "s", 1))
    got = lm_hpy.score(table(spark, rows)).collect()
    check_lm(spark, rows, got)
    held = [r for r in got if r["held_out"] and r["doc_id"] != odd]
    per_token = sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert per_token > -0.5 and all(r["base_score"] / r["n_tokens"] < -2 for r in held)
    assert all(r["score"] / r["n_tokens"] < -1.5 for r in got if r["doc_id"] == odd)


def exact_tables(c, a, d):
    """P of 1, 2, ... tables of c customers."""
    p = np.zeros(c + 1)
    p[1] = 1.0
    for n in range(1, c):
        p = p * np.maximum(n - d * np.arange(c + 1), 0) + a * np.concatenate(([0], p[:-1]))
        p /= p.sum()
    return p


def test_drawn_tables_follow_the_exact_distribution():
    rng, n = np.random.default_rng(0), 20_000
    for c, a, d in ((2, 0.3, 0.8), (4, 0.8, 0.5), (40, 5.0, 0.7), (256, 0.01, 0.9), (256, 90.0, 0.3)):
        t = lm_hpy.draw_tables(np.full(n, c), np.full(n, a), d, rng)
        got = np.bincount(t, minlength=c + 1) / n
        assert len(got) == c + 1 and np.abs(np.cumsum(got) - np.cumsum(exact_tables(c, a, d))).max() < 0.015
    for c, a, d in ((257, 30.0, 0.8), (3000, 0.01, 0.8), (3000, 4.0, 0.6), (3000, 60.0, 0.8), (3000, 1000.0, 0.5), (3000, 20.0, 0.05)):
        t = lm_hpy.draw_tables(np.full(n, c), np.full(n, a), d, rng)
        got = np.bincount(t, minlength=c + 1) / n
        assert len(got) == c + 1 and np.abs(np.cumsum(got) - np.cumsum(exact_tables(c, a, d))).max() < 0.06
    assert lm_hpy.draw_tables(np.array([1, 10**9]), np.array([3.0, 1e-9]), 0.5, rng).tolist() == [1, 1]


def toy(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    counts = np.zeros((n, lm_hpy.CONTEXTS), np.int64)
    for i in range(n):
        for u in rng.integers(0, lm_hpy.CONTEXTS, int(min(rng.zipf(1.6), 3000))):
            counts[i, u] += 1
    guess = np.where(counts > 0, counts**0.7, 0)
    totals = {
        "d1": 0.7, "d0": 0.5, "base": 1 / (n + 1), "served": counts.sum(axis=0).astype(float), "tables": guess.sum(axis=0),
        "parent_customers": guess.sum(), "parent_tables": (guess.sum(axis=1) ** 0.5).sum(),
    }
    return counts, totals


def test_seatings_are_consistent():
    counts, totals = toy()
    t, r = lm_hpy.sample_seatings(counts, totals, np.random.default_rng(1))
    assert ((t >= 1) == (counts >= 1)).all() and (t <= counts).all()
    assert (r >= 1).all() and (r <= t.sum(axis=2)).all()


def test_all_customers_of_frequent_words_are_reseated():
    """Words of the same large counts get tables as different as the posterior
    says, not one start with a few moves."""
    n = 400
    counts = np.full((n, lm_hpy.CONTEXTS), 50_000)
    totals = {
        "d1": 0.7, "d0": 0.5, "base": 1 / (n + 1), "served": counts.sum(axis=0).astype(float), "tables": np.full(lm_hpy.CONTEXTS, 1e5),
        "parent_customers": 8e5, "parent_tables": 4e3,
    }
    t, r = lm_hpy.sample_seatings(counts, totals, np.random.default_rng(1))
    assert ((t >= 1) & (t <= counts)).all() and ((r >= 1) & (r <= t.sum(axis=2))).all()
    assert t.std(axis=1).min() > 10 and (abs(t[1] - t[0]) > 6).mean() > 0.5


def test_draws_agree_with_moves_one_by_one():
    rng, n, c, a, d = np.random.default_rng(0), 5000, 12, 2.0, 0.6
    s, rows = lm_hpy.Seating(np.full(n, c), np.full(n, 2), 12), np.arange(n)
    for _ in range(150):
        s.leave(rows, rng)
        s.enter(rows, np.full(n, a), d, rng)
    drawn = lm_hpy.draw_tables(np.full(n, c), np.full(n, a), d, rng)
    assert abs(drawn.mean() - s.tables.mean()) < 0.1 and abs(drawn.std() - s.tables.std()) < 0.1


def test_each_sample_is_a_distribution():
    """The averaged predictive sums to one over the words and the unknown."""
    counts, totals = toy()
    t, r = lm_hpy.sample_seatings(counts, totals, np.random.default_rng(1))
    sums = {c: float(t[s, :, u].sum()) for s, cols in enumerate(lm_hpy.TABLES) for u, c in enumerate(cols)}
    sums |= {c: float(r[s].sum()) for s, c in enumerate(lm_hpy.PARENT)}
    model = lm_hpy.Predictive(totals, sums)
    p = model.parent(t.sum(axis=2), r).T @ model.backoff / lm_hpy.SAMPLES + np.where(counts > 0, model.seen(counts, t), 0)
    assert np.allclose(p.sum(axis=0) + model.unknown, 1, atol=1e-9) and (p > 0).all()


def test_facts_round_trip():
    counts, totals = toy(500)
    counts = np.concatenate((counts, [[1 << 33, 0, 0, 0, 0, 0, 0, 7], [70_000] * 8]))
    t, r = lm_hpy.sample_seatings(counts, totals, np.random.default_rng(1))
    data, offs = lm_hpy.encode_facts(counts, t, r.T)
    c, t2, r2 = lm_hpy.decode_facts(data, np.append(offs, offs[-1]))
    assert (c[:-1] == counts).all() and (t2[:, :-1] == t).all() and (r2[:-1] == r.T).all()
    assert not c[-1].any() and not t2[:, -1].any()


def test_gibbs_follows_the_exact_posterior():
    """One dish with four customers and a new-table weight a: the number of
    tables is compared with the sum over all seatings."""
    d, a, c = 0.5, 0.8, 4
    weight = Counter()

    def seat(sizes, n, w):
        if n == c:
            weight[len(sizes)] += w
            return
        for k, s in enumerate(sizes):
            seat([*sizes[:k], s + 1, *sizes[k + 1 :]], n + 1, w * (s - d))
        seat([*sizes, 1], n + 1, w * a)

    seat([1], 1, 1.0)
    total = sum(weight.values())
    rng, n = np.random.default_rng(0), 20_000
    s = lm_hpy.Seating(np.full(n, c), np.full(n, 2), 4)
    rows = np.arange(n)
    for _ in range(40):
        s.leave(rows, rng)
        s.enter(rows, np.full(n, a), d, rng)
    assert (s.customers == c).all() and ((s.size * s.many).sum(axis=1) == c).all() and (s.many.sum(axis=1) == s.tables).all()
    for k in range(1, c + 1):
        assert abs((s.tables == k).mean() - weight[k] / total) < 0.015


def test_expected_tables():
    assert lm_hpy.expected_tables(np.array([1, 2, 10**6]), np.full(3, 1e-9), 0.5).tolist() == [1, 1, 1]
    assert lm_hpy.expected_tables(np.array([50]), np.array([1e9]), 0.5).tolist() == [50]


# ------------------------------------------------------------------- chat

HARD = ["", "\\### Assistant: </turn> ok", "### User: x </turn>\n", "\\", "\\\\#<", " </turn>\n", "a: b", "é\U0001f600\x00", "\n\n"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="\\#<>: a\n/turn", max_size=8), st.text(alphabet="\\#<>: a\n/turn", max_size=20)), max_size=5))
def test_template_round_trip(turns):
    text = "".join(chat.turn_text(r, t)[0] for r, t in turns)
    assert chat.parse(text) == turns


def conversation_rows():
    rng = random.Random(1)
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(HARD)]
    rows += [(2, 0, "system", "be brief"), (2, 1, "user", None), (2, 2, "assistant", "yes"), (2, 2, "assistant", "yes")]
    rows += [(3, None, None, "no turn"), (3, 5, "assistant", "x " * 3000), (None, 1, "user", "no id"), (4, 0, "assistant", "alone")]
    rows += [(5, 0, "system", prose(rng, 10))] + [(5, k, "assistant" if k % 2 == 0 else "user", prose(rng, rng.randrange(1, 60))) for k in range(1, 60)]
    rng.shuffle(rows)
    return rows


def ordered(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    return {k: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))] for k, v in out.items()}


def test_chat_with_long_runs_of_white_space(spark):
    texts = [" " * 1_100_000, "\n" * 1_100_000 + "x"]
    rows = [(1, k, "assistant", t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (got,) = chat.read_back(chat.windows(df)).collect()
    loss = "".join(texts)
    assert got["n_turns"] == len(texts) and got["loss_chars"] == len(loss)
    assert got["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_digests_and_budget(spark):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, window int, tokens int")
    windows = chat.windows(df, budget=400, history=200)
    got = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    want = ordered(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    by_conv = {}
    for w in windows.orderBy("window").collect():
        by_conv.setdefault(w["conv_id"], []).append(w)
    for conv, ws in by_conv.items():
        assert got[conv]["formatted_chars"] == sum(len(w["text"]) for w in ws)
        at = 0
        for w in ws:
            turns = chat.parse(w["text"])
            assert w["first_turn"] == at and len(turns) == w["n_repeated"] + w["n_new"] and w["n_new"] >= 1
            assert w["tokens"] <= 400 or w["n_new"] == 1
            own = want[conv]
            assert turns[w["n_repeated"] :] == own[at : at + w["n_new"]]
            history = turns[: w["n_repeated"]]
            if at and ("system", own[0][1]) == own[0] and conv == 5:
                assert history[0] == own[0]
                history = history[1:]
            assert history == own[at - len(history) : at]
            masked = [w["text"][a:b] for a, b in zip(w["loss_spans"][::2], w["loss_spans"][1::2], strict=True)]
            assert [chat.unescape(m) for m in masked] == [t for r, t in own[at : at + w["n_new"]] if r == "assistant"]
            at += w["n_new"]
    assert any(w["n_repeated"] > 1 for w in by_conv[5])
    assert chat.windows(df.limit(0)).count() == 0 and chat.read_back(chat.windows(df.limit(0))).count() == 0
