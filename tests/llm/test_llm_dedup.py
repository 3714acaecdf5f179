"""Exact, SimHash, substring and suffix-array dedup against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cadenza.llm import exact_dedup, packing, simhash, substring_dedup, suffix_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def by_id(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}


def exact_expected(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    groups = {}
    for i, t in norm.items():
        groups.setdefault(t, []).append(i)
    return {i: (min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest())
            for i, t in norm.items()}


@pytest.mark.parametrize("bits", [64, 4])
def test_exact(odd_docs, odd_rows, bits):
    """Also with keys so narrow that nearly every chunk's is shared."""
    out = exact_dedup.exact_dedup(odd_docs, key_bits=bits)
    assert by_id(out, "keep_id", "group_size", "kept", "text_sha256") == exact_expected(odd_rows)


def test_exact_edge_cases(empty_docs, make_docs):
    assert exact_dedup.exact_dedup(empty_docs).collect() == []
    out = exact_dedup.exact_dedup(make_docs([(None, "a b"), (5, "a  b"), (5, "a b"), (None, "z"), (6, None), (8, "")]))
    rows = sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in out.collect())
    assert rows == [(0, 0, 1, True), (0, 5, 3, False), (5, 5, 3, True), (5, 5, 3, True), (6, 6, 2, True), (8, 6, 2, False)]


def test_chunks_join_to_the_text(odd_docs):
    norm = exact_dedup.normalised(F.col("text"))
    c = exact_dedup.chunks(norm)
    bad = odd_docs.select(norm.alias("n"), c.alias("c")).where(
        (F.concat_ws("", "c") != F.col("n")) | F.exists("c", lambda x: F.length(x) > exact_dedup.MAX_CHUNK))
    assert bad.count() == 0


def test_exact_plan_is_native(odd_docs):
    plan = exact_dedup.exact_dedup(odd_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_rows_that_stay(make_docs):
    docs = make_docs([(3, "a b"), (1, "a  b"), (1, "a  b"), (2, "c"), (None, "d")])
    out = exact_dedup.without_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "d"), (1, "a  b"), (2, "c")]


def test_exact_rows_of_one_id_equal_after_normalisation(make_docs):
    docs = make_docs([(1, "a b"), (1, "a  b"), (1, "a\tb"), (None, "c d"), (None, "c \n d"), (None, None), (None, ""), (2, "e")])
    out = exact_dedup.without_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, " ".join((r.text or "").split())) for r in out.collect()) == [(0, ""), (0, "c d"), (1, "a b"), (2, "e")]


#: Names that the stages use inside, each given to an extra column.
INNER = ("id sub t32 k_id k_sha text_sha256 sha salt salts copies uses rows norm chunks chunk key recipe ordinals kept found hot "
         "late hits lead part fp least root node component k table bits spread bucket b shard row n_tokens score y p kind").split()


@pytest.mark.parametrize("stage", [exact_dedup.without_copies, simhash.without_near_copies, substring_dedup.without_repeats, packing.pack])
def test_stages_with_inner_names_as_columns(spark, stage):
    rows = [(1, "a b c d " + PASSAGE), (2, "a b  c d " + PASSAGE), (3, "z " + PASSAGE), (None, None), (3, "z " + PASSAGE)]
    docs = spark.createDataFrame([(i, t, *("x" for _ in INNER)) for i, t in rows],
                                 "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in INNER))
    plain = docs.select("doc_id", "text")
    got, want = stage(docs), stage(plain)
    if stage is not packing.pack:
        assert got.columns == docs.columns
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def fingerprints(rows, shingle=3):
    import xxhash
    out = {}
    for i, t in rows:
        w = [x.lower() for x in WORD.findall((t or "").encode())]
        parts = [b" ".join(w[k:k + shingle]) for k in range(max(1, len(w) - shingle + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
        out[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return out


def groups(fp, bits):
    ids = sorted(fp)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fp[a] ^ fp[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("bits", [3, 0])
def test_simhash(odd_docs, odd_rows, bits):
    fp = fingerprints(odd_rows)
    root = groups(fp, bits)
    out = simhash.simhash_dedup(odd_docs, max_bits=bits)
    assert by_id(out, "fingerprint", "component_id") == {i: (f"{fp[i]:016x}", root[i]) for i in fp}


def test_simhash_shingle_lengths_agree_with_spark(odd_docs, odd_rows, spark):
    one = [(i, (t or "").split(" ")[0]) for i, t in odd_rows]
    got = {r.doc_id: r.fp for r in simhash.fingerprints(spark.createDataFrame(one, "doc_id long, text string")).collect()}
    ascii_one = [(i, t) for i, t in one if t and t.isascii() and len(t.split()) == 1]
    want = spark.createDataFrame(ascii_one, "i long, t string").select("i", F.xxhash64(F.lower("t")).alias("h"))
    assert {r.i: r.h for r in want.collect()} == {i: got[i] for i, _ in ascii_one}


def test_links_find_every_close_pair_in_hot_lists(spark):
    """One dense cloud of fingerprints, cut into many small parts."""
    import random
    r = random.Random(1)
    centre = r.getrandbits(64)
    fps = {centre}
    for _ in range(300):
        x = centre
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randrange(64)
        fps.add(x)
    fps |= {r.getrandbits(64) for _ in range(100)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    pairs = [(row.a, row.b) for row in simhash.links(df, part=16).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 64 for a, b in pairs)
    from cadenza.llm.graph import components
    got = {row.node: row.component for row in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = groups({signed(x): x for x in fps}, 3)
    assert {i: got.get(i, i) for i in expected} == expected


def test_simhash_edge_cases(empty_docs, make_docs):
    assert simhash.simhash_dedup(empty_docs).collect() == []
    out = simhash.simhash_dedup(make_docs([(None, ""), (4, None), (9, "a b c d"), (9, "a b c d"), (None, "zz yy xx")]))
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in out.collect()) == [(0, 0), (0, 4), (4, 4), (9, 9), (9, 9)]
    docs = make_docs([(2, "a b c d e"), (1, "a b c d e"), (3, "other words here")])
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_simhash_keeps_one_row_of_each_group(make_docs):
    """Null-only groups, null with an id, repeated ids in one and in several groups, repeated rows."""
    near = lambda words: [words, words.upper(), words.replace(" ", "  ")]
    nulls, mixed, repeated, twice = (near(x) for x in ("a b c d e", "f g h i j k", "l m n o p q", "r s t u v w"))
    rows = [(None, t) for t in nulls] + [(None, mixed[0]), (None, mixed[1]), (4, mixed[2])]
    rows += [(9, t) for t in repeated] + [(9, "some words in a group of their own")]
    rows += [(11, twice[0]), (11, twice[0]), (12, twice[1])] + [(None, None), (None, ""), (None, " ")]
    docs = make_docs(rows)
    out = simhash.without_near_copies(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or 0, " ".join((r.text or "").lower().split())) for r in out.collect())
    assert got == [(0, ""), (0, "a b c d e"), (4, "f g h i j k"), (9, "l m n o p q"),
                   (9, "some words in a group of their own"), (11, "r s t u v w")]


@pytest.mark.parametrize("shape", ["path", "star", "cycles"])
def test_components(spark, shape):
    from cadenza.llm.graph import components
    n = 200
    edges = {"path": [(i, i + 1) for i in range(n)], "star": [(n, i) for i in range(n)],
             "cycles": [(i, (i + 5) % 100) for i in range(100)] + [(500, 500)]}[shape]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    if shape == "cycles":
        assert got == {i: i % 5 for i in range(100)}
    else:
        assert got == dict.fromkeys(range(n + 1), 0)


def substring_expected(rows, window):
    seen, out = {}, {}
    for i, t in sorted(rows):
        w = (t or "").encode().split()
        off = [False] * len(w)
        for k in range(len(w) - window + 1):
            q = tuple(w[k:k + window])
            if q in seen:
                off[k:k + window] = [True] * window
            seen.setdefault(q, i)
        out[i] = (len(w), sum(off), b" ".join(x for x, o in zip(w, off, strict=True) if not o).decode())
    return out


@pytest.mark.parametrize("window,block", [(20, None), (20, 7), (5, None), (1, None)])
def test_substring(odd_docs, odd_rows, window, block):
    out = substring_dedup.substring_dedup(odd_docs, window, block)
    assert by_id(out, "n_words", "n_removed", "text") == substring_expected(odd_rows, window)


def test_substring_edge_cases(empty_docs, make_docs):
    assert substring_dedup.substring_dedup(empty_docs).collect() == []
    p = " ".join(f"v{i}" for i in range(25))
    out = substring_dedup.substring_dedup(make_docs([(None, p), (5, "x " + p), (5, p + " y"), (7, p + " " + p)]))
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in out.collect())
    # a null id is last; rows of one id leave each other alone
    assert got == [(0, 25, 25), (5, 26, 0), (5, 26, 0), (7, 50, 50)]
    with pytest.raises(ValueError):
        substring_dedup.substring_dedup(empty_docs, window=5, block=4)


def test_substring_stage_keeps_rows_and_columns(make_docs):
    p = " ".join(f"v{i}" for i in range(25))
    docs = make_docs([(1, p), (2, "new " + p), (3, None)])
    out = substring_dedup.without_repeats(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r.doc_id, r.text, r.n_chars, r.kept, r.rest) for r in out.collect()) == [
        (1, p, len(p), "k", "r"), (2, "new", 3, "k", "r"), (3, "", 0, "k", "r")]


def ragged(rows):
    """(doc_id, n_words, n_removed, kept) by brute force, also where ids repeat:
    rows of one id do not remove each other's words."""
    first, out = {}, []
    key = lambda i: 2**63 if i is None else i
    split = [(key(i), i, (t or "").encode().split()) for i, t in rows]
    for k, _, w in split:
        for s in range(len(w) - 19):
            q = tuple(w[s:s + 20])
            first[q] = min(first.get(q, k), k)
    for k, i, w in split:
        off, own = [False] * len(w), set()
        for s in range(len(w) - 19):
            q = tuple(w[s:s + 20])
            if first[q] < k or q in own:
                off[s:s + 20] = [True] * 20
            own.add(q)
        out.append((i or 0, len(w), sum(off), b" ".join(x for x, o in zip(w, off, strict=True) if not o).decode()))
    return sorted(out)


def shared_runs():
    """Pairs of documents that share 1 to 40 words, at every offset in a block."""
    rows = []
    for size in range(1, 41):
        for lead in range(0, 12, 1 + size % 4):
            run = [f"s{size}.{lead}.{k}" for k in range(size)]
            n = len(rows)
            rows.append((n + 1, " ".join([f"a{size}.{lead}.{k}" for k in range(10)] + run + [f"a{k}.{size}.{lead}" for k in range(30)])))
            rows.append((n + 2, " ".join([f"b{size}.{lead}.{k}" for k in range(lead)] + run + [f"b{k}.{size}.{lead}" for k in range(25)])))
    return rows


def got_substring(out):
    return sorted((r.doc_id or 0, r.n_words, r.n_removed, r.text) for r in out.collect())


@pytest.mark.parametrize("parts", [1, 2, 211])
def test_substring_shared_runs(spark, make_docs, parts):
    rows = shared_runs()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert got_substring(substring_dedup.substring_dedup(make_docs(rows))) == ragged(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


FIFTEEN = ["a0 a1 a2 a3 a4 a5 a6 a7 a8 a9 " + " ".join(f"s{k}" for k in range(15)) + " x" + str(d) for d in range(2)]
PASSAGE = " ".join(f"v{k}" for k in range(35))


@pytest.mark.parametrize("rows", [
    [(1, FIFTEEN[0]), (2, FIFTEEN[1])], [(1, PASSAGE), (1, PASSAGE)], [(7, PASSAGE)] * 20, [(None, PASSAGE)] * 20,
    [(7, PASSAGE + " " + PASSAGE)] * 1200 + [(3, PASSAGE), (9, "z")],
    [(None, PASSAGE + f" t{k}") for k in range(30)] + [(None, PASSAGE + " t1")] * 3 + [(4, PASSAGE + " q")],
    [(i % 3, f"{PASSAGE} u{i % 5}") for i in range(40)]], ids=range(7))
def test_substring_repeated_ids(make_docs, rows):
    assert got_substring(substring_dedup.substring_dedup(make_docs(rows))) == ragged(rows)
    docs = make_docs(rows)
    out = substring_dedup.without_repeats(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted((i, t) for i, _, _, t in ragged(rows))


def narrow(text, seed):
    """A hash that separates nothing under the first two seeds."""
    return F.xxhash64(text, F.lit(seed)) if seed > 1 else F.lit(5).cast("long")


def test_names_of_rows_are_unique_where_hashes_clash(make_docs):
    long = "".join(chr(97 + i * i % 26) + str(i) for i in range(300))
    rows = [(None, PASSAGE + " a"), (None, "b " + PASSAGE), (7, PASSAGE), (7, "c"), (None, PASSAGE + " a"), (8, long), (8, long + "y"), (7, long)]
    assert got_substring(substring_dedup.substring_dedup(make_docs(rows), sub=narrow)) == ragged(rows)
    out = suffix_dedup.suffix_dedup(make_docs(rows), keep="none", sub=narrow).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in out) == suffix_any(rows)


def suffix_any(rows, width=200):
    """(doc_id, n_bytes, n_removed) where rows are told apart by their place."""
    from collections import Counter
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(b[k:k + width] for b in texts for k in range(len(b) - width + 1))
    out = []
    for (i, _), b in zip(rows, texts, strict=True):
        off = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if count[b[k:k + width]] > 1:
                off[k:k + width] = b"\1" * width
        out.append((i or 0, len(b), sum(off)))
    return sorted(out)


def test_suffix_repeated_ids(make_docs):
    long = "".join(chr(97 + i * i % 26) + str(i) for i in range(300))
    rows = [(None, long)] * 2500 + [(7, "short")] * 3 + [(7, long[:300] + "x"), (9, long[500:] * 2)]
    out = suffix_dedup.suffix_dedup(make_docs(rows), keep="none").collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in out) == suffix_any(rows)
    first = suffix_dedup.suffix_dedup(make_docs([(None, long)] * 2500 + [(None, "z")])).collect()
    assert sorted((r.n_bytes - r.n_removed for r in first), reverse=True)[:3] == [len(long), 1, 0] and len(first) == 2501


def suffix_expected(rows, width, first):
    from collections import Counter
    texts = {i: (t or "").encode() for i, t in sorted(rows)}
    count = Counter(b[k:k + width] for b in texts.values() for k in range(len(b) - width + 1))
    seen, out = set(), {}
    for i, b in texts.items():
        off = bytearray(len(b))
        for k in range(len(b) - width + 1):
            q = b[k:k + width]
            if (q in seen) if first else count[q] > 1:
                off[k:k + width] = b"\1" * width
            seen.add(q)
        spans = sum(1 for k in range(len(b)) if off[k] and (k == 0 or not off[k - 1]))
        out[i] = (len(b), sum(off), spans, bytes(x for x, o in zip(b, off, strict=True) if not o))
    return out


@pytest.mark.parametrize("width", [200, 40])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_suffix(odd_docs, odd_rows, width, keep):
    rows = [(i, t) for i, t in odd_rows if len(t or "") < 20_000]
    docs = odd_docs.where(F.length(F.coalesce("text", F.lit(""))) < 20_000)
    out = suffix_dedup.suffix_dedup(docs, width, keep)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()}
    assert got == suffix_expected(rows, width, keep == "first")


@pytest.mark.parametrize("width,keep,many", [(200, "none", 0), (200, "first", 2), (40, "none", 2), (40, "first", 0)])
def test_suffix_with_hot_anchors(odd_docs, odd_rows, width, keep, many):
    rows = [(i, t) for i, t in odd_rows if len(t or "") < 6_000]
    docs = odd_docs.where(F.length(F.coalesce("text", F.lit(""))) < 6_000)
    out = suffix_dedup.suffix_dedup(docs, width, keep, many)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()}
    assert got == suffix_expected(rows, width, keep == "first")


def test_suffix_flanks_of_a_hot_passage_part(make_docs):
    """One passage between other flanks in each document, a few of them shared."""
    import random

    from cadenza.llm.common import named
    r = random.Random(7)
    text = lambda n: "".join(r.choice("abcdefghijklmnop ") for _ in range(n))
    passage, shared = text(400), text(250)
    rows = [(i, (shared if i % 40 == 0 else text(250)) + passage + text(250)) for i in range(300)]
    docs = make_docs(rows)
    largest = {many: suffix_dedup._sent(named(docs).unique, 200, 64, False, many, 8).where("kind <> 1").groupBy("p").agg(
        F.sum(F.length("text")).alias("n")).agg(F.max("n")).first()[0] for many in (20, 10**9)}
    assert largest[10**9] > 250 * 200 and largest[20] < 20 * 336 * 2
    for keep in ("none", "first"):
        out = suffix_dedup.suffix_dedup(docs, keep=keep, many=20)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()}
        assert got == suffix_expected(rows, 200, keep == "first")


def test_suffix_edge_cases(empty_docs, make_docs):
    assert suffix_dedup.suffix_dedup(empty_docs).collect() == []
    p = "".join(chr(97 + i * i % 26) + str(i) for i in range(100))
    docs = make_docs([(None, p), (5, "x" + p), (5, p + "y"), (6, None)])
    assert sorted((r.doc_id or 0, r.n_bytes - r.n_removed) for r in suffix_dedup.suffix_dedup(docs, keep="none").collect()) == [
        (0, 0), (5, 1), (5, 1), (6, 0)]
    kept = sum(r.n_bytes - r.n_removed for r in suffix_dedup.suffix_dedup(docs).collect())
    assert kept == len(p) + 2  # one copy, and the odd letters of two rows


def test_factor_matches_by_suffix_order():
    import numpy as np
    text = b"abcabcabx" + b"q" * 30 + b"zabcabcabx"
    for width in (9, 17, 20, 45):
        starts = np.arange(len(text) - width + 1)
        earlier, later = suffix_dedup.factor_matches(text, starts, width)
        parts = [text[s:s + width] for s in starts]
        assert earlier.tolist() == [p in parts[:s] for s, p in enumerate(parts)]
        assert later.tolist() == [p in parts[s + 1:] for s, p in enumerate(parts)]


@pytest.mark.parametrize("merged", [1, 50, 10**9])
def test_probes_seen_twice(monkeypatch, merged):
    import numpy as np
    from collections import Counter

    from cadenza.llm import blobs
    monkeypatch.setattr(blobs, "MERGED", merged)
    r = np.random.default_rng(3)
    probed, counts = blobs._Probed(), Counter()
    for _ in range(20):
        values, n = np.unique(r.integers(0, 400, 30).astype(np.uint64), return_counts=True)
        probed.add(values, values[n > 1])
        counts.update(dict(zip(values.tolist(), n.tolist(), strict=True)))
    asked = np.arange(500, dtype=np.uint64)
    assert probed.hits(asked).tolist() == [counts[int(v)] > 1 for v in asked]
    assert not blobs._Probed().hits(asked).any()
