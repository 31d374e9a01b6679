"""The operators against brute force, and on null, empty, long, tied and repeated rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdrlake.llm import decontam, langid, licenses, linededup, onepermutation, pieces, simhash, suffix, tokenbin, toxicity
from cdrlake.llm.common import hot_join
from cdrlake.llm.components import components
from cdrlake.llm.encoding import ColumnEncoder
from cdrlake.llm.queries import BYTE_BPE, PIECES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, h string"
EDGE = [
    (0, "alpha beta gamma\nsecond line here\nthird line here", "en", "s", 1, "r", "h"),
    (1, None, "en", "s", 1, "r", "h"),
    (2, "", None, "s", 1, "r", "h"),
    (3, "second line here\nthird line here\n\nown", "en", "s", 1, "r", "h"),
    (4, "12 34 !!", "fr", None, 1, "r", "h"),
    (5, "mot été là " * 3000, "fr", "s", 1, "r", "h"),
    (5, "mot été là " * 3000, "fr", "s", 1, "r", "h"),
    (None, "no id at all in this row", "en", "s", 1, "r", "h"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


# --- 1 ---------------------------------------------------------------------------


def brute_lines(rows, w=2, long=100):
    seen, out = set(), {}
    for d, text in sorted(rows):
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for k in range(len(at) - w + 1):
            key = tuple(lines[i] for i in at[k : k + w])
            gone |= set(at[k : k + w]) if key in seen else set()
            seen.add(key)
        for i in at:
            if len(lines[i].strip(" ")) >= long:
                gone |= {i} if lines[i] in seen else set()
                seen.add(lines[i])
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_line_dedup_equals_brute_force(docs):
    want = brute_lines(texts_of(docs).items())
    got = {r["doc_id"]: r["text"] for r in linededup.deduplicated(docs).collect()}
    assert got == want


def test_line_dedup_on_edge_rows(edge, empty):
    rows = linededup.deduplicated(edge).collect()
    assert len(rows) == len(EDGE) and rows[0].asDict().keys() == set(edge.columns)
    by_id = {r["doc_id"]: r["text"] for r in rows}
    assert by_id[3] == "\nown" and by_id[1] is None and by_id[2] == ""
    assert linededup.line_dedup(empty).collect() == []


def test_one_long_line_is_a_passage(spark):
    passage = "word " * 50
    rows = [(1, f"a\n{passage}\nb"), (2, f"c\n{passage}\nd"), (3, f"{passage}"), (4, "a\nc"), (5, f"e\n{passage}\nb")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["runs"]) for r in linededup.line_dedup(table).collect()}
    assert got == {1: (0, None), 2: (1, "1-1"), 3: (1, "0-0"), 4: (0, None), 5: (2, "1-2")}


# --- hot keys ----------------------------------------------------------------------


def test_hot_join_deals_out_a_key(spark):
    rows = spark.range(3_000).select("id", F.when(F.col("id") < 2_000, 7).otherwise(F.col("id")).alias("k"))
    unique = spark.range(0, 2_500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = sorted(tuple(r) for r in hot_join(rows, unique, ["k"], ["id"]).select("id", "v").collect())
    assert got == [(i, 14 if i < 2_000 else 2 * i) for i in range(2_500)]
    assert hot_join(rows, unique, ["k"], ["id"], "left").count() == 3_000
    assert hot_join(rows, unique, ["k"], ["id"], "left_semi").count() == 2_500


# --- 2 ---------------------------------------------------------------------------


def test_licenses_match_ordered_sentences(spark):
    header = licenses.RULES["apache-2.0-header"][1]
    rows = [
        (1, "x\n" + ". ".join(header) + "."), (2, ". ".join(header[::-1]) + "."), (3, "Released under the MIT License."),
        (4, None), (5, ""), (3, "Released under the MIT License."),
    ]
    got = sorted(tuple(r) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, "Apache-2.0", "apache-2.0-header", len(header)), (3, "MIT", "mit-short", 1), (3, "MIT", "mit-short", 1)]


def test_licences_that_contain_each_other(spark):
    bsd3 = ".\n".join(licenses.RULES["bsd-3-clauses"][1]).replace(":.", ":") + "."
    bsd2 = ".\n".join(licenses.RULES["bsd-clauses"][1]).replace(":.", ":") + "."
    mit = "Copyright (c) 2020 X. All rights reserved.\n\n" + ".\n".join(licenses.RULES["mit-text"][1]).replace(":.", ":") + "."
    headers = [". ".join(licenses.RULES[r][1]) + "." for r in ("gpl-2.0-header", "lgpl-2.1-header", "gpl-3.0-header", "mpl-2.0-notice")]
    texts = [bsd3, bsd2, mit, *headers, "// SPDX-License-Identifier: MIT\nint x;", "# SPDX-License-Identifier: GPL-2.0-only", "All rights reserved.", None, ""]
    rows = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["license"]) for r in rows) == [
        (0, "BSD-3-Clause"), (1, "BSD-2-Clause"), (2, "MIT"), (3, "GPL-2.0-or-later"), (4, "LGPL-2.1-or-later"), (5, "GPL-3.0-or-later"),
        (6, "MPL-2.0"), (7, "MIT"), (8, "GPL-2.0-only"), (9, "proprietary"),
    ]
    assert licenses.license_scan(spark.createDataFrame([], "doc_id long, text string, rule string")).collect() == []


def test_wrapped_licenses_in_long_texts(spark):
    import textwrap

    def text(rule, width, mark, list_mark=""):
        own = [(x if x.endswith(":") else x + ".") for x in licenses.RULES[rule][1]]
        if rule == "apache-2.0-header":
            own = [own[0][:-1] + "; " + own[1] + " " + own[2][:-1], "    http://www.apache.org/licenses/LICENSE-2.0", own[3] + " " + own[4]]
        elif rule == "gpl-3.0-header":
            own = [own[0], own[1] + "  " + own[2]]
        lines = [line for k, p in enumerate(own) for line in [*textwrap.wrap((f"{k}{list_mark} " if list_mark and k else "") + p, width), ""]]
        return "\n".join(f"{mark}{x}".rstrip() for x in lines)

    filler = "prose without end, and more of it.\n" * 100
    sizes = {rule: n for rule, _, _, n in licenses.rule_sequences()}
    want, rows = [], []
    for rule in ("apache-2.0-header", "mit-text", "gpl-3.0-header", "bsd-clauses"):
        for width in (40, 72):
            for mark in ("", "# ", " * ", "// ", ";; ", "dnl ", "! "):
                for list_mark in ("", ".", ")"):
                    want.append((len(rows), licenses.RULES[rule][0], rule, sizes[rule]))
                    rows.append((len(rows), filler + text(rule, width, mark, list_mark if rule == "bsd-clauses" else "") + "\n" + filler))
    # a blank line or a stop ends a sentence; a part of a line is none
    rows += [(len(rows), "Released under\n\nthe MIT License."), (len(rows) + 1, "Released under. the MIT License."), (len(rows) + 2, "not Released under\nthe MIT License.")]
    want.append((len(rows), "MIT", "mit-short", 1))
    rows.append((len(rows), "x\r\n/* Released under\r\n * the MIT" + " " * 3_000 + "License. */"))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in licenses.license_scan(table).collect()) == want


# --- 3 ---------------------------------------------------------------------------


def test_fingerprints_follow_the_next_document(docs):
    order = sorted(texts_of(docs).items(), reverse=True)
    rows = {r["doc_id"]: r for r in onepermutation.document_fingerprints(docs).collect()}
    errors = []
    for k, (d, a) in enumerate(order):
        b, n = order[(k + 1) % len(order)][1], len(a) // 3
        edited = a[: len(a) - n] + b[:n]
        assert (rows[d]["n_chars"], rows[d]["edited_sha256"]) == (len(a), hashlib.sha256(edited.encode()).hexdigest())
        x, y = ({tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, edited))
        errors.append(abs(len(x & y) / len(x | y) - rows[d]["near_edited"]))
    assert np.mean(errors) < 0.05 and max(errors) < 0.25


def test_fingerprints_on_edge_rows(edge, empty):
    rows = onepermutation.document_fingerprints(edge).collect()
    assert len(rows) == len(EDGE) and onepermutation.document_fingerprints(empty).collect() == []
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert prints[1] == prints[2] and len({r["fingerprint"] for r in rows if r["doc_id"] == 5}) == 1
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))


# --- 4 ---------------------------------------------------------------------------


def test_bit_sliced_pairs_equal_brute_force():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 400, dtype=np.int64).astype(np.uint64)
    for i in range(0, 398, 3):
        values[i + 1] = values[i] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False)))
    ends = np.repeat([100, 101, 400], [100, 1, 299])
    got = set(zip(*(x.tolist() for x in simhash.close_pairs(values, ends))))
    want = {(i, j) for i in range(400) for j in range(i + 1, int(ends[i])) if (int(values[i]) ^ int(values[j])).bit_count() <= 4}
    assert got == want


@pytest.mark.parametrize("tile", [4096, 3])
def test_no_link_is_lost_in_large_buckets(spark, tile):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(-(2**62), 2**62, 20)]
    prints = sorted({b ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(0, 5), replace=False)) for b in base for _ in range(20)})
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), tile=tile)
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    near = {p: [q for q in prints if ((p ^ q) & (2**64 - 1)).bit_count() <= 4] for p in prints}
    label, before = dict(zip(prints, prints)), None
    while label != before:
        before = label
        label = {p: min(before[q] for q in near[p]) for p in prints}
    assert {p: root.get(p, p) for p in prints} == label


def test_components_of_a_chain(spark):
    rows = components(spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")).collect()
    assert {(r["node"], r["root"]) for r in rows} == {(i, 0) for i in range(1, 41)} | {(100, 99)}


def test_one_document_of_each_group(edge, empty):
    rows = simhash.one_of_each(edge).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows) == [(False, 0), (False, 1), (False, 3), (False, 4), (False, 5), (True, None)]
    assert simhash.near_duplicates(empty).collect() == []


# --- 5 ---------------------------------------------------------------------------


def test_token_files_read_back(edge, empty, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTE_BPE)
    both = docs.select("doc_id", "text").union(edge.filter("doc_id < 5").select(F.col("doc_id") + 10_000, F.concat("text", F.lit("  \n \tx"))))
    rows = {r["doc_id"]: r for r in tokenbin.token_bin(both, BYTE_BPE).collect()}
    start = 0
    for d, text in sorted(texts_of(both).items()):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        got = rows[d]
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokenbin.token_bin(empty, BYTE_BPE).collect() == []


def test_added_tokens_are_those_of_the_library():
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", " <|endoftext|>", "<|endoftext|>", " word", "x\n<|endoftext|>y", None, "plain words here"]
    texts += ["a  b", "a\n\nb", "a \nb", "a\n b", "a\t b", " \tb", "x  \tb", "\n\nb", "b  ", "b \n", "b\n\n\nc", "a\x0b\nb", "a\x85\x85b", "\u3000\u3000 b", "it's 's"]
    flat, sizes = ColumnEncoder(BYTE_BPE, bound=3).encode(pa.array(texts), None)
    want = [e.ids for e in Tokenizer.from_file(BYTE_BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, want)) and flat.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 100, 1000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**17, n).astype(np.uint32)
    assert (tokenbin.unpack(tokenbin.pack(ids, block=64, bits=bits)) == ids).all()


# --- 6 ---------------------------------------------------------------------------


def test_tiling_catches_reordered_passages(spark):
    words = [f"w{i}" for i in range(30)]
    item = " ".join(words)
    rows = [
        (1, f"before it {item} behind"), (2, " ".join(words[15:] + ["x"] + words[:15])), (3, " ".join(words[:12])), (4, None), (5, ""),
        (1, f"before it {item} behind"),
    ]
    bench = spark.createDataFrame([(7, item), (8, "too short"), (9, None), (7, item)], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontam.leaks(docs, bench).collect()}
    assert got == {(1, 7): 1.0, (2, 7): 1.0}
    assert sorted(r["doc_id"] for r in decontam.without_leaks(docs, bench).collect()) == [3, 4, 5]
    assert decontam.leaks(docs.limit(0), bench).collect() == [] and decontam.leaks(docs, bench.limit(0)).collect() == []


def test_every_text_of_an_item_is_searched_for(spark):
    first, second, third = (" ".join(f"{c}{i}" for i in range(20)) for c in "abc")
    bench = spark.createDataFrame([(7, first), (7, second), (None, third)], "item_id long, text string")
    docs = spark.createDataFrame([(1, first), (2, second), (3, third), (4, "own words")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench).collect()} == {(1, 7), (2, 7), (3, None)}
    assert [r["doc_id"] for r in decontam.without_leaks(docs, bench).collect()] == [4]


def test_tiles_are_longest_first_and_do_not_overlap():
    got = decontam.tiles([1, 2, 3, 4, 5, 6, 7, 8], [5, 6, 7, 8, 0, 1, 2, 3, 4, 5, 6], 2)
    assert got == [(0, 5, 6), (6, 2, 2)]


# --- 7 ---------------------------------------------------------------------------


def test_pieces_are_lossless_and_reproducible(edge, empty, docs):
    from sentencepiece import SentencePieceProcessor

    rows = pieces.round_trip(docs, PIECES).collect()
    assert all(r["lossless"] for r in rows) and len(rows) == docs.count()
    again = {r["doc_id"]: r["pieces"] for r in pieces.round_trip(docs.repartition(7), PIECES).collect()}
    assert again == {r["doc_id"]: r["pieces"] for r in rows}
    other = {r["doc_id"]: r["lossless"] for r in pieces.round_trip(edge, PIECES).collect()}
    assert all(other.values()) and pieces.round_trip(empty, PIECES).collect() == []
    assert SentencePieceProcessor(model_file=PIECES).vocab_size() > max(max(p) for p in again.values() if p)


def test_samples_follow_the_lattice():
    lattice = pieces.Lattice(PIECES)
    flat, counts = lattice.encode(["the"] * 4000, np.arange(4000))
    cuts = np.r_[0, np.cumsum(counts)]
    seen = {}
    for a, z in zip(cuts[:-1], cuts[1:]):
        seen[tuple(flat[a:z].tolist())] = seen.get(tuple(flat[a:z].tolist()), 0) + 1
    weights = {p: np.exp(sum(lattice.weights[i] for i in p)) for p in seen}
    total = sum(weights.values())
    assert all(abs(n / 4000 - weights[p] / total) < 0.03 for p, n in seen.items())


@pytest.mark.parametrize("text", ["a▁b  c", "日本\U0001f600é", " " * 40 + "z", "\n\n x\t", "x" * 500])
def test_any_text_decodes(text):
    lattice = pieces.lattice(PIECES)
    assert lattice.decode(*lattice.encode([text, None, ""], np.arange(3))) == [text, "", ""]


# --- 8 ---------------------------------------------------------------------------


def test_suffix_array_equals_sorting():
    rng = np.random.default_rng(0)
    for n in [*range(1, 30), 200]:
        for k in (1, 2, 4):
            s = rng.integers(1, k + 1, n)
            assert suffix.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def brute_bytes(rows, length=100):
    seen, out = set(), {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=int)
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(raw[i : i + length])
        gone = np.cumsum(gone)[: len(raw)] > 0
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[d] = (len(raw), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest())
    return out


@pytest.mark.parametrize("most", [2048, 2])
def test_suffix_dedup_equals_brute_force(spark, docs, most, monkeypatch):
    monkeypatch.setattr(suffix.repeats, "__defaults__", (100, most))
    extra = [(9000, "ab" * 300), (9001, None), (9002, ""), (9003, "x" * 250 + "ab" * 90), (9004, "é" * 99)]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.suffix_dedup(rows).collect()}
    assert got == brute_bytes(list(texts_of(rows).items()))


def test_suffix_array_refuses_what_its_keys_cannot_hold():
    with pytest.raises(ValueError):
        suffix.suffix_array(np.array([1, 1 << 21, 2, 3]))
    with pytest.raises(ValueError):
        suffix.suffix_array(np.ones(1 << 23, dtype=np.int64))


def test_windows_of_a_hot_passage_are_not_sorted(spark, monkeypatch):
    # one passage, each time in a context of its own: every run around it differs
    passage = hashlib.sha512(b"p").hexdigest() * 3
    own = [hashlib.sha512(str(i).encode()).hexdigest() for i in range(300)]
    rows = [(i, f"{x} {passage} {x[::-1]}") for i, x in enumerate(own)]
    table = spark.createDataFrame([*rows, rows[7]], "doc_id long, text string")
    monkeypatch.setattr(suffix.repeats, "__defaults__", (100, 16))
    joined = []
    windows = suffix.later_windows
    monkeypatch.setattr(suffix, "later_windows", lambda w, n: joined.append(w.groupBy("h", "w").count().agg(F.max("count")).first()[0]) or windows(w, n))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.suffix_dedup(table).collect()}
    assert got == brute_bytes(rows) and joined[0] >= 250


def test_suffix_dedup_on_edge_rows(edge, empty):
    rows = [r for r in suffix.suffix_dedup(edge).collect() if r["doc_id"] == 5]
    assert len(rows) == 2 and len({r["kept_sha256"] for r in rows}) == 1  # one document
    assert suffix.suffix_dedup(empty).collect() == []


# --- 9 ---------------------------------------------------------------------------


def test_held_out_languages_are_right(docs):
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95


def test_language_of_edge_rows(edge, empty):
    got = {r["doc_id"]: r for r in langid.identify(edge).collect()}
    assert {d for d, r in got.items() if r["lang_pred"] == "und"} == {1, 2, 4} and got[1]["score"] == 0 and got[None]["held_out"] is False
    assert langid.identify(empty).collect() == []
    assert [r["lang_pred"] for r in langid.identify(edge.withColumn("lang", F.lit(None).cast("string"))).collect()] == ["und"] * len(EDGE)
    assert langid.keep_identified(edge).columns == edge.columns


# --- 10 --------------------------------------------------------------------------


def brute_toxicity(rows, labels, min_share, neighbours=10):
    """Scores by comparing every text with every example, in plain Python."""
    import math

    texts = dict(rows)
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in texts}
    marked = {d: y for d, y in labels if not held[d]}
    split = lambda t: [f for w in re.split(r"[\W]+", (t or "").lower()) if w for f in toxicity.forms(w)]
    own = {d: Counter(split(t)) for d, t in texts.items()}
    seen = Counter(f for d in marked for f in own[d])
    names = {f for f, n in seen.items() if n >= max(2.0, min_share * len(marked))}
    df = Counter(f for c in own.values() for f in c if f in names)
    unit = {}
    for d, c in own.items():
        v = {f: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[f])) + 1) for f, n in c.items() if f in names}
        norm = math.sqrt(sum(x * x for x in v.values()))
        unit[d] = {f: x / norm for f, x in v.items()}
    groups = {}
    for d in sorted(marked):
        if unit[d]:
            groups.setdefault(tuple(sorted((f, own[d][f]) for f in unit[d])), []).append(d)

    def vote(d, alone=False):
        found = []
        for members in groups.values():
            if alone and d in members:
                members = [m for m in members if m != d]
            if members:
                other = unit[members[0]]
                found.append((round(sum(x * other.get(f, 0.0) for f, x in unit[d].items()), 9), members))
        found = sorted((x for x in found if x[0] > 0), key=lambda x: -x[0])
        if len(found) > neighbours and found[neighbours][0] == found[neighbours - 1][0]:
            return None  # a tie at the edge, which order decides
        power = lambda c: (1.02 - c) ** -8.0
        total = sum(power(c) * len(m) for c, m in found[:neighbours])
        return sum(power(c) * marked[x] for c, m in found[:neighbours] for x in m) / total if total else math.nan

    return {d: vote(d) for d in texts}, {d: vote(d, True) for d in marked}


def test_votes_equal_full_search(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows, marks = [(r["doc_id"], r["text"]) for r in docs.collect()], [(r["doc_id"], r["toxic"]) for r in labels.collect()]
    want, left_out = brute_toxicity(rows, marks, 0.05)
    marked = {d: y for d, y in marks if zlib.crc32(str(d).encode()) % 5}
    pairs = [(left_out[d], y) for d, y in marked.items() if left_out[d] is not None]
    heights, shares = toxicity.monotone(np.array([0.0, 1.0] + [v for v, _ in pairs if v == v]), np.array([0.0, 1.0] + [float(y) for v, y in pairs if v == v]))
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels, min_share=0.05, neighbours=10).collect()}
    base = np.mean(list(marked.values()))
    assert None not in left_out.values()
    for d, v in want.items():
        if v is not None:
            assert abs(got[d]["score"] - (base if v != v else np.interp(v, heights, shares))) < 1e-6, d


def test_block_search_equals_full_search():
    rng = np.random.default_rng(3)
    weight = rng.random(300) + 0.5
    term, tf, sizes = [], [], []
    for _ in range(3000):
        low = 150 * int(rng.integers(0, 2))  # two kinds of entries, so that blocks can be left out
        own = np.unique(low + rng.integers(0, 150, rng.integers(1, 9)))
        term.append(own)
        tf.append(rng.integers(1, 4, len(own)))
        sizes.append(len(own))
    index = toxicity.Index(weight, np.concatenate(term), np.concatenate(tf), sizes, np.ones(3000), rng.integers(0, 2, 3000), list(range(3000)))
    dense = np.zeros((3000, 300))
    for i, (t, n) in enumerate(zip(term, tf)):
        dense[i, t] = (1 + np.log(n)) * weight[t]
    dense /= np.sqrt((dense**2).sum(axis=1, keepdims=True))
    old = toxicity.DENSE
    try:
        for toxicity.DENSE in (0, 20, 300):
            index.ready = False
            bounds = np.r_[0, np.cumsum(sizes[:60]), sum(sizes[:60])]
            found = list(index.nearest(bounds, np.concatenate(term[:60]), np.concatenate(tf[:60])))
            assert len(found) == 61 and not len(found[60][0])
            for i in range(60):
                scores = np.round(dense @ dense[i], 9)
                want = np.sort(scores[scores > 0])[::-1][: toxicity.NEIGHBOURS]
                cosines, entries = found[i]
                assert np.allclose(cosines, want, atol=2e-9) and np.allclose(scores[[index.ids[e] for e in entries]], cosines, atol=2e-9)
    finally:
        toxicity.DENSE = old


def test_monotone_chances():
    votes, labels = np.array([0.1, 0.2, 0.2, 0.3, 0.9, 0.9]), np.array([0, 1, 0, 0, 1, 1.0])
    heights, shares = toxicity.monotone(votes, labels)
    assert heights.tolist() == [0.1, 0.1, 0.2, 0.3, 0.9, 0.9] and (np.diff(shares) >= 0).all() and 0 < shares[0] < shares[-1] < 1


def test_held_out_toxicity(spark):
    docs = spark.createDataFrame([(i, ("you idiot clown " if i % 4 == 0 else "kind words only ") + f"w{i} tail") for i in range(400)] + [(900, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(400)] + [(3, None, 1), (4, 1, 1)], "doc_id long, toxic int, quality int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 401 and all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in rows if r["doc_id"] < 400)
    assert all(0 <= r["score"] <= 1 for r in rows) and sum(r["held_out"] for r in rows) > 40
    assert toxicity.toxicity(docs, labels.limit(0)).filter("score > 0").count() == 0
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_toxic_texts_are_found_at_every_size(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = [r["doc_id"] for r in labels.filter("toxic = 1").collect()]
    example = next(d for d in toxic if zlib.crc32(str(d).encode()) % 5)
    texts = texts_of(docs)
    more = spark.createDataFrame([(9002, " ".join(texts[example].split()[1:]))], "doc_id long, text string")
    marks = labels.select("doc_id", "toxic")
    rows = {r["doc_id"]: r for r in toxicity.toxicity(docs.select("doc_id", "text").union(more), marks).collect()}
    assert np.mean([rows[d]["predicted"] for d in toxic]) >= 0.7 and rows[9002]["predicted"] and example in rows[9002]["evidence"]
    clean = [r["doc_id"] for r in labels.filter("toxic = 0").collect()]
    assert np.mean([rows[d]["predicted"] for d in clean]) < 0.05


# --- pipeline --------------------------------------------------------------------


def test_pipeline_keeps_columns_and_decisions(spark, docs):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert out.columns == [*docs.columns, "pieces", "n_pieces"] and 0 < len(rows) < docs.count()
    want = brute_lines(texts_of(docs).items())
    assert all(want[r["doc_id"]] == r["text"] for r in rows)
    leaks = {r["doc_id"] for r in decontam.leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert not leaks & {r["doc_id"] for r in rows}
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECES


def test_every_stage_takes_edge_and_empty_tables(spark, edge, empty):
    import corpus_pipeline

    for table in (edge, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert docs.columns[: len(edge.columns)] == edge.columns
        assert docs.count() == (0 if table is empty else 4)
