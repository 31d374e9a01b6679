"""Conversation repair, importance resampling and packing against brute force, and on edge rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cdrlake.llm import langid, linededup, packing, pieces, repair, resampling, similar, simhash
from cdrlake.llm.components import components
from cdrlake.llm.encoding import ColumnEncoder
from cdrlake.llm.queries import PIECES, QUERIES, WORD_BPE

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- 11 --------------------------------------------------------------------------


def damage_one(conv, turn, role, text):
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [(turn, role, text)] * (2 if kind == 3 else 1)


def cheapest(roles, faults):
    """Plain dynamic programme over whole audits: least (cost, audit) of each state."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def with_inserts(table):
        for _ in range(3):
            for q, (c, audit) in list(table.items()):
                for to in after[q]:
                    if to != "s":
                        table[to] = min(table.get(to, (10**9, "")), (c + 2, audit + "I"))
        return table

    table = with_inserts({"": (0, "")})
    for role, fault in zip(roles, faults):
        new = {}

        def offer(q, c, audit, new=new):
            new[q] = min(new.get(q, (10**9, "")), (c, audit))

        for q, (c, audit) in table.items():
            offer(q, c + 3, audit + "D")
            if fault in "t-":
                late = fault == "t"
                for to in after[q]:
                    if role[:1] == to:
                        offer(to, c + late, audit + "K")
                    if to != "s":
                        offer(to, c + 2 + late, audit + "R")
        table = with_inserts(new)
    return min(table[q] for q in ("", "a") if q in table)


def rewritten(audit, rows):
    out, at, state = [], 0, ""
    for edit in audit:
        turn_role = "assistant" if state == "u" else "user"
        if edit == "D":
            at += 1
            continue
        if edit == "I":
            out.append((turn_role, ""))
        else:
            out.append((rows[at][1] if edit == "K" else turn_role, rows[at][2]))
            at += 1
        state = out[-1][0][:1]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return out


def brute_repair(table):
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        convs[conv] += damage_one(conv, turn, role, text)
    out = {}
    for conv, rows in convs.items():
        mark = "" if conv is None else f"={conv}"
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{mark}\0{r[1]}\0{r[2]}".encode()).digest()))
        seen, faults = set(), ""
        for _, role, text in rows:
            stripped = text.strip(" \t\n\v\f\r")
            faults += "b" if not stripped else "d" if (role, text) in seen else "-" if stripped[-1] in ".!?" else "t"
            seen.add((role, text))
        cost, audit = cheapest([r for _, r, _ in rows], faults)
        turns = [t for t, _, _ in rows if t is not None]
        left = rewritten(audit, rows)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
        )
    return out


def repaired_by_spark(df):
    rows = repair.conversation_repair(df).collect()
    out = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def test_search_equals_exhaustive_programme():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randrange(9)
        codes, faults = "".join(rng.choices("suat", (1, 3, 3, 1), k=n)), "".join(rng.choices("bdt-", (1, 1, 1, 5), k=n))
        cost, audit, _ = repair.search(codes, faults, repair.suffix_bounds(codes, faults, repair.FINAL), repair.START, True)
        assert (cost, audit) == cheapest(codes, faults), (codes, faults)


def test_search_over_segments_equals_that_over_all():
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randrange(1, 40)
        codes, faults = "".join(rng.choices("sua", k=n)), "".join(rng.choices("bdt-", (1, 1, 1, 3), k=n))
        cuts = [0, *sorted(rng.choices(range(n + 1), k=3)), n]
        parts = [(codes[a:b], faults[a:b]) for a, b in itertools.pairwise(cuts)]
        behind = [list(repair.FINAL)]
        for c, f in reversed(parts):
            table = [repair.suffix_bounds(c, f, [0 if q == to else repair._NEVER for q in range(4)])[0] for to in range(4)]
            behind.append([min(table[to][q] + behind[-1][to] for to in range(4)) for q in range(4)])
        behind.reverse()
        q, cost, audit = repair.START, 0, ""
        for i, (c, f) in enumerate(parts):
            spent, own, q = repair.search(c, f, repair.suffix_bounds(c, f, behind[i + 1]), q, i == len(parts) - 1)
            cost, audit = cost + spent, audit + own
        assert (cost, audit) == cheapest(codes, faults)


def test_repair_equals_brute_force(spark):
    table = spark.read.parquet(f"{BIG}/conversations.parquet")
    want = brute_repair([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert repaired_by_spark(table) == want and len(want) == 100
    assert QUERIES["op11_conversation_repair"](spark, BIG).count() == 100


def edge_turns():
    rng = random.Random(5)
    rows = [
        (1, None, "user", "Hi."), (1, None, None, None), (1, 3, "system", "x."), (1, 3, "assistant", "ok"), (1, 9, "", "End!"),
        (None, 1, "user", "A?"), (None, 2, "assistant", "B."), (None, None, None, "c"), (2, None, "user", ""), (3, 0, "tool", "long " * 40_000 + "."),
        (4, 1, "user", "Hi."), (4, 1, "user", "Hi."), (4, 1, "user", "Hi."), (4, 2, "assistant", "\t\n "),
    ]
    dropped = [c for c in range(1000, 1200) if zlib.crc32(f"{c}:1".encode()) % 20 == 0][:3]
    rows += [(c, 1, "user", "gone.") for c in dropped]
    rows += [(7, t, rng.choice(["user", "assistant", "system", "User"]), rng.choice(["a.", "b", "", "c!", f"{t}."])) for t in range(600)]
    rows += [(c, t, "uas"[t % 3] + "x", f"{t % 4}.") for c in range(50, 80) for t in range(c % 7)]
    return rows


def test_repair_on_edge_rows_and_over_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "ROWS", 37)
    table = spark.createDataFrame([(*r, "clash", 1) for r in edge_turns()], "conv_id long, turn long, role string, text string, key string, part int")
    want = brute_repair(edge_turns())
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            # the workers read ROWS from the shipped package; long conversations are cut by the ranges as well
            assert repaired_by_spark(table) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
    named = table.withColumn("conv_id", F.col("conv_id").cast("string"))
    assert repaired_by_spark(named) == {None if k is None else str(k): v for k, v in brute_repair([(None if c is None else str(c), *r) for c, *r in edge_turns()]).items()}
    assert repair.conversation_repair(table.limit(0)).collect() == []


def test_a_conversation_of_many_segments(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"{t}.", f"{t}", "", "again."])) for t in range(9000)]
    rows += [(c, t, "user" if t % 2 else "assistant", f"{t}.") for c in (0, 2) for t in range(5)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    solved = repair.repair(repair.damaged(table))
    assert solved.filter("conv_id = 1").count() >= 2
    assert repaired_by_spark(table) == brute_repair(rows)
    first = repair.repaired_turns(solved).filter("conv_id = 1").orderBy("part", "chunk", "place").collect()
    assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in first).encode()).hexdigest() == brute_repair(rows)[1][-1]


# --- 12 --------------------------------------------------------------------------


def brute_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_resample(rows, target, percent=10, least=20, longest=1):
    def runs(text):
        w = brute_words(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    of_docs = Counter(bucket(f) for _, text in rows for f in runs(text))
    of_target = Counter(bucket(f) for text in target for f in runs(text))
    s, t = sum(of_docs.values()), sum(of_target.values())
    gain = {b: math.floor(1000 * math.log((of_target[b] + 1) * (s + 10_000) / ((of_docs[b] + 1) * (t + 10_000)))) for b in range(10_000)}
    out = []
    for doc, text in rows:
        own = runs(text)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(brute_words(text))])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = [(r, i + 1) for i, r in enumerate(able[: percent * len(able) // 100])]
    drawn = {id(r): i for r, i in rank}
    return sorted(((*r[:4], drawn.get(id(r))) for r in out), key=repr)


def test_resampling_equals_brute_force(spark):
    docs, target = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/benchmark.parquet")
    pairs, texts = [(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()]
    got = QUERIES["op12_importance_resampling"](spark, BIG)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(pairs, texts)
    two = resampling.resample(docs, target, longest=2)
    assert sorted(map(tuple, two.collect()), key=repr) == brute_resample(pairs, texts, longest=2)


def test_a_missed_bracket_is_widened(spark):
    scores = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit(30).cast("long").alias("n_features"), F.lit(30).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("weight"), F.expr("CASE WHEN id % 3 = 0 THEN 7 ELSE pmod(id * 7919, 1009) END").alias("score"),
    )
    want = {r["doc_id"] for r in scores.orderBy(F.desc("score"), "doc_id").limit(3000).collect()}  # the cutoff lies among the ties
    low, high, over = resampling.bracket(scores, 5000, 4999, margin=1e-9)
    assert over < 4999 <= over + scores.filter(F.col("score").between(low, high)).count()
    drawn, others = resampling.resampled(scores, percent=60, margin=1e-9)
    assert {r["doc_id"] for r in drawn.collect()} == want and others.count() == 2000


def test_resampling_on_edge_rows(spark):
    text = "One two, THREE été 4 five six seven eight nine ten eleven twelve a b c d e f g h"
    rows = [(1, text), (1, text), (None, text), (None, text + " z"), (2, None), (3, ""), (4, "!? \n"), (5, "long word " * 30_000)]
    rows += [(i, f"{text} {i}") for i in range(10, 40)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, score long, bucket string")
    target = spark.createDataFrame([("two three",), (None,), ("",)], "text string")
    assert sorted(map(tuple, resampling.resample(table, target).collect()), key=repr) == brute_resample(rows, ["two three", None, ""])
    assert sorted(map(tuple, resampling.resample(table, target.limit(0)).collect()), key=repr) == brute_resample(rows, [])
    assert resampling.resample(table.limit(0), target).collect() == []


# --- 13 --------------------------------------------------------------------------


def ids_of(texts):
    return [e.ids + [1] for e in Tokenizer.from_file(WORD_BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = ["", None, "a  b", "don't we'll x's 12 3.4", "a <|endoftext|> b", "É́ ́x ΣΑΣ ß", "a\x0b\nb\x85c　d", "<|startoftext|>", " ", "\n\n", "x" * 5000]


def test_column_encoder_equals_the_tokenizer(docs):
    texts = [r["text"] for r in docs.collect()] + ODD
    encoder = ColumnEncoder(WORD_BPE, bound=2000)
    for column in (pa.array(texts), pa.array(ODD, pa.large_string()), pa.array(texts).slice(7, 50)):
        flat, counts = encoder.encode(column, 1)
        assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == ids_of(column.to_pylist())


def check_pieces(pieces, rows, capacity=2048):
    """Every id of every document in exactly one piece, no gap in a sequence; returns the share of padding."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]))
    total = padding = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        total, padding = total + at, padding + (0 if at & (at - 1) == 0 else capacity - at)
    for (doc, _), ids in zip(rows, ids_of([t for _, t in rows])):
        raw, at = np.array(ids, dtype="<u4").tobytes(), 0
        for start, length, crc, n in sorted(by_doc[doc]):
            assert start == at and n == len(ids) and crc == zlib.crc32(raw[4 * start : 4 * (start + length)])
            at += length
        assert at == len(ids)
    return padding / max(1, total)


def test_packing_keeps_every_id_once(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()]
    pieces = QUERIES["op13_packing"](spark, BIG)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check_pieces(pieces.collect(), rows) < 0.002


def test_groups_and_edge_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "word " * (i * 37 % 2500)) for i in range(300)] + [(1000, "long text " * 40_000)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, ids long, start string")
    found = packing.digests(packing.pack(table, WORD_BPE, group=50)).collect()
    assert check_pieces(found, rows) < 0.01
    again = spark.createDataFrame([(5, "one two"), (5, "one two"), (None, "one"), (None, None)], "doc_id long, text string")
    got = packing.digests(packing.pack(again, WORD_BPE)).collect()
    assert sum(p["length"] for p in got) == 3 + 3 + 2 + 1 and {p["doc_id"] for p in got} == {5, None}
    assert packing.digests(packing.pack(table.limit(0), WORD_BPE)).collect() == []


def test_first_fit_decreasing_equals_plain_search():
    rng = random.Random(3)
    for _ in range(200):
        sizes = np.array([rng.randrange(1, 101) for _ in range(rng.randrange(60))], dtype=np.int64)
        bins, free = [], []
        for i in np.argsort(-sizes, kind="stable").tolist():
            at = next((b for b, left in enumerate(free) if left >= sizes[i]), None)
            if at is None:
                bins.append([])
                free.append(100)
                at = len(bins) - 1
            bins[at].append(i)
            free[at] -= int(sizes[i])
        got = packing.first_fit_decreasing(sizes, 100)
        assert got == bins
        parts = packing.filled(got, sizes, 100, 3)
        assert all(sum(n for *_, n in own) <= 100 for own in parts)
        odd = [n for n in (sum(n for *_, n in own) for own in parts) if n < 97]
        assert all(n & (n - 1) == 0 for n in odd)
        covered = sorted((i, at, n) for own in parts for i, at, n in own)
        for i, own in itertools.groupby(covered, key=lambda x: x[0]):
            at = 0
            for _, start, n in own:
                assert start == at
                at += n
            assert at == sizes[i]
        assert sum(n for *_, n in covered) == sizes.sum()


# --- the pipeline's near-dedup stage, and promises of earlier operators -----------------


def word_runs(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar_pairs(texts, least=0.8):
    """Pairs of different texts that are similar, from shingles in few of them."""
    sets = {d: word_runs(t) for d, t in texts.items() if t}
    holders = defaultdict(list)
    for d, own in sets.items():
        for x in own:
            holders[x].append(d)
    near = {pair for own in holders.values() if len(own) <= 300 for pair in itertools.combinations(sorted(own), 2)}
    return {(a, b) for a, b in near if texts[a] != texts[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}


def test_near_duplicates_of_the_stage(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pairs = similar_pairs(texts)
    kept = {r["doc_id"] for r in simhash.one_of_each(docs).collect()}
    assert len(pairs) >= 10 and sum(not (a in kept and b in kept) for a, b in pairs) >= 0.9 * len(pairs)
    # what goes is a copy of, or similar to, something: nothing else is taken
    loosely = {d for pair in similar_pairs(texts, 0.7) for d in pair}
    copies = Counter((t or "") if (t or "").strip() else "" for t in texts.values())
    assert all(d in loosely or copies[(texts[d] or "") if (texts[d] or "").strip() else ""] > 1 for d in texts.keys() - kept)


def test_edited_copies_of_one_original_stay_together(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(5000)]
    original = rng.choices(vocabulary, k=400)
    rows = [(0, " ".join(original))]
    for i in range(1, 120):
        words = list(original)
        for at in rng.sample(range(400), 8):  # some 40 of 396 shingles change: similarity 0.82 to the original, less to others
            words[at] = "edited"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(rng.choices(vocabulary, k=300))) for i in range(50)] + [(2000, None), (2001, ""), (None, "one two"), (2002, "one two")]
    rows += [(3000, "word " * 30_000), (3001, "word " * 30_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    kept = {r["doc_id"] for r in simhash.one_of_each(table).collect()}
    assert kept == {0, *range(1000, 1050), 2000, 2002, 3000}
    assert simhash.one_of_each(table.limit(0)).collect() == []


def test_sketches_give_the_similarity():
    rng = np.random.default_rng(0)
    for n in (3, 100, 5000):
        a = rng.integers(0, 2**32, n, dtype=np.uint32)
        b = np.r_[a[: n * 8 // 10], rng.integers(0, 2**32, n // 5 + 1, dtype=np.uint32)]
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = similar.similarity(np.unique(a)[: similar.SKETCH], np.unique(b)[: similar.SKETCH])
        assert abs(got - exact) < (1e-9 if n < 400 else 0.08)


def test_piece_chances_do_not_depend_on_the_batch(docs):
    model = pieces.Lattice(PIECES)
    stretches = sorted({s for r in docs.collect() for s in pieces._STRETCH.findall(r["text"] or "")})[:4000]

    def chances(run):
        first, states, sizes, length, _, chance = model._edges(run)
        ends = np.r_[first, len(length)]
        return [chance[ends[a] : ends[a + n]].tolist() for a, n in zip(states.tolist(), sizes.tolist())]

    whole = chances(stretches)
    for size in (1, 7, 333):
        assert [x for at in range(0, len(stretches), size) for x in chances(stretches[at : at + size])] == whole


def test_language_scores_equal_plain_sums(spark, docs):
    languages, model = langid.train(docs, "doc_id", "text", "lang", max_rows=150)
    texts = [r["text"] for r in docs.collect()][:60] + ["a", "\u00e9t\u00e9 " * 20_000]
    for run, bounds, hashed, letters in langid._grams(texts, len(model) - 1):
        full = np.flatnonzero(bounds[:, 1] > bounds[:, 0])
        for n in range(langid.ORDERS):
            got = langid.weighed(hashed[n], bounds[full], model[:-1])
            want = [sum(model[hashed[n][k]] for k in range(*bounds[i])) for i in full]
            assert np.allclose(got, want, rtol=1e-9)
            one = langid.weighed(hashed[n], bounds[full[-1:]], model[:-1])
            assert np.allclose(one[0], want[-1], rtol=1e-9)


def test_a_small_share_of_the_labelled_rows_still_learns(spark, docs):
    languages, model = langid.train(docs, "doc_id", "text", "lang", max_rows=1)
    assert model.shape[1] == len(languages) <= 4
    many = spark.range(200_000).selectExpr("id AS doc_id", "'some english words' AS text", "'en' AS lang")
    learned, table = langid.train(many, "doc_id", "text", "lang", max_rows=50)
    assert learned == ["en"]


def test_long_lines_have_a_second_hash(spark):
    rows = [(i, "x" * 200 + str(i)) for i in range(50)] + [(100, "x" * 200 + "7")]
    windows = linededup._windows(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 2, 100)
    found = windows.collect()
    assert len({(r["fp"], r["window"]) for r in found}) == 50 and all(r["fp"] != ~r["window"] for r in found)


@pytest.mark.parametrize("tile", [2, 1_024])
def test_no_similar_pair_of_a_band_is_left_out(spark, monkeypatch, tile):
    """Groups were compared with the member that meets most others and with the smallest one only."""
    rng = np.random.default_rng(8)
    texts = {n: np.unique(rng.integers(0, 2**32, 300, dtype=np.uint32)) for n in (1, 2, 4, 9)}
    for n, of in ((3, 2), (5, 4), (6, 5)):  # some 20 hashes of 300 are others
        texts[n] = np.unique(np.r_[rng.permutation(texts[of])[20:], rng.integers(0, 2**32, 20, dtype=np.uint32)])
    rows = [(n, [7, 70 + n % 2], s.view(np.int32).tolist()) for n, s in texts.items()]
    monkeypatch.setattr(similar, "_sketches", lambda _: spark.createDataFrame(rows, "node long, keys array<long>, sketch array<int>"))
    edges = similar.similar_links(spark.createDataFrame([(1, "a")], "node long, text string"), tile=tile)
    root = {r.node: r.root for r in components(edges).collect()}
    assert root == {3: 2, 5: 4, 6: 4}


def test_one_set_against_several():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 2_000, n, dtype=np.uint32))[: similar.SKETCH] for n in (1, 40, 300, 700, 1_200, 3_000)]
    bounds = np.r_[0, np.cumsum([len(s) for s in sets])]
    for one in sets:
        assert similar.similarities(one, np.concatenate(sets), bounds).tolist() == [similar.similarity(one, s) for s in sets]
