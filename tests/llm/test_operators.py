"""Operators of tidewater.llm against brute force on small tables: the smallest
test table, and rows made of every awkward case."""

import base64
import gzip
import io
import os
import sys
import tarfile
import zlib
from collections import Counter, defaultdict
from urllib.parse import quote, quote_plus

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import brute  # noqa: E402
from conftest import SF_SMALL, rows  # noqa: E402,F401

from tidewater.llm import containment, encoding, exact_dedup, lm_scoring, near_dedup, pieces, queries, secrets, sharding, substring_dedup, toxicity, warc  # noqa: E402

PASSAGE = " ".join(f"w{i}" for i in range(70))
AWKWARD = [
    (1, PASSAGE + " tail one"),
    (2, "head two " + PASSAGE),
    (3, None),
    (4, ""),
    (5, " \t\r\n "),
    (6, "Same  text here"),
    (7, "Same text\there"),
    (7, "Same text\there"),
    (8, "SAME TEXT HERE"),
    (None, PASSAGE + " tail one"),
    (None, None),
    (9, "x" * 5000 + " " + PASSAGE * 3),
    (10, "▁ mark   and \U0001f600 emoji\n\n  spaces   "),
    (11, " ".join(f"w{i}" for i in range(69)) + " other"),
]
SCHEMA = "doc_id long, text string, rep string, n int, value string, label long, `a.b` int"


def awkward(spark, data=AWKWARD):
    return spark.createDataFrame([(*r, "r", 1, "v", 2, 3) for r in data], SCHEMA)


def small(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.collect()]


def table(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("source", ["awkward", "small", "empty"])
def test_against_brute_force(spark, source):
    df, data = small(spark) if source == "small" else (awkward(spark, AWKWARD if source == "awkward" else []), AWKWARD if source == "awkward" else [])
    sub = substring_dedup.substring_dedup(df)
    from pyspark.sql import functions as F

    same(table(sub.withColumn("s", F.sha2(F.col("kept_text").cast("binary"), 256)), "doc_id", "n_words", "n_removed", "s"), brute.substring(data))
    tagged = df.withColumn("text_sha256", F.sha2(exact_dedup.normalised(F.col("text")), 256))
    same(table(exact_dedup.exact_groups(tagged, digest="text_sha256"), "doc_id", "keep_id", "group_size", "kept", "text_sha256"), brute.exact(data))
    same(table(exact_dedup.exact_groups(df), "doc_id", "keep_id", "group_size", "kept"), [r[:4] for r in brute.exact(data)])
    for n in (4, 5):
        same(table(near_dedup.near_duplicates(df, n=n), "doc_id", "n_shingles", "component_id", "kept"), brute.near(data, n))
    items = [(1, PASSAGE), (2, "same text here"), (3, None), (4, ""), (5, "w1 w2 w3 w4 w5 w6 zz"),
             (6, "W3 w4\tw5"), (7, "other"), (8, "w68 w70"), (9, "text here"), (9, "text here"), (9, "Text  here"), (None, "w9 w10 w11 w12")]
    table_ = spark.createDataFrame(items, "item_id long, text string")
    got = table(containment.contained_items(df, table_), "doc_id", "item_id", "n_item", "n_shared")
    same(got, brute.contained(data, list(dict.fromkeys(items))))
    kept = containment.decontaminated(df, table_)
    assert kept.columns == df.columns
    bad = [d for d, t in data if brute.contained([(d, t)], items)]
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, _ in data) - Counter(bad)


def test_containment_without_room(spark, monkeypatch):
    """A filter far too small and values dealt to several tasks: the same pairs. Items
    of one to four words in long texts, and items that many documents hold."""
    rng = np.random.default_rng(11)
    data = [(i, " ".join(f"k{x}" for x in rng.integers(0, 60, rng.integers(1, 300)))) for i in range(60)]
    items = [(i, " ".join(f"k{x}" for x in rng.integers(0, 60, 1 + i % 4))) for i in range(40)]
    items += [(100 + i, " ".join(data[i][1].split()[:40]).upper()) for i in range(20)]
    df, table_ = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute.contained(data, items)
    assert len({i for _, i, *_ in want if i < 100}) > 15
    for bits, share in ((1 << 29, 1 << 16), (1 << 15, 3)):
        monkeypatch.setattr(containment, "BITS_PER_VALUE", 1 if share == 3 else 32)
        monkeypatch.setattr(containment, "MAX_BITS", bits)
        monkeypatch.setattr(containment, "SHARE", share)
        same(table(containment.contained_items(df, table_), "doc_id", "item_id", "n_item", "n_shared"), want)
    leaked = {d for d, *_ in want}
    assert {r["doc_id"] for r in containment.decontaminated(df, table_).collect()} == {d for d, _ in data} - leaked


def test_containment_looks_up_many_documents_as_one_by_one():
    """Documents laid end to end have the keys that each has alone: no run of words goes
    over the end of one, and each is held to its own size."""
    rng = np.random.default_rng(5)
    h = [containment.mix64(rng.integers(0, 400, n).astype(np.uint64)) for n in (30, 0, 3, 1, 200, 5, 4, 60)]
    h.append(np.concatenate([h[0][-3:], h[4][:3]]))
    parts = [(m, containment.partition_of(m, 1 << k), (1 << 64) - 1 >> k % 2) for m in (2, 5) for k in range(6)]
    keys = [containment.keyed(containment.shingle_values(x, m), p) for x in h for m in (2, 5) for p in (m, *[p for k, p, _ in parts if k == m])]
    bits = np.zeros(1 << 17, np.uint8)
    for x in keys[::2]:
        for i in range(containment.PROBES):
            at = containment.probe(x, i, 8 * len(bits)).astype(np.int64)
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    owner, got = containment.looked_up(np.concatenate(h), np.array([len(x) for x in h]), parts, 80, 100, bits)
    alone = []
    for i, x in enumerate(h):
        own = set()
        for m, part, cut in parts:
            values = containment.shingle_values(x, m)
            if 100 * len(values) >= 80 * (1 << (part & 255) - 1):
                values = values[values <= np.uint64(cut)]
                values = values[np.isin(containment.keyed(values, m), containment.in_filter(containment.keyed(values, m), bits))]
                own |= set(containment.in_filter(containment.keyed(values, part), bits).tolist())
        alone += [(i, k) for k in sorted(own)]
    assert alone and list(zip(owner.tolist(), got.tolist())) == alone


def test_containment_filter():
    keys = containment.keyed(np.arange(1000, dtype=np.uint64), 3)
    bits = np.zeros(1 << 12, np.uint8)
    for i in range(containment.PROBES):
        at = containment.probe(keys, i, 8 * len(bits)).astype(np.int64)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    assert (containment.in_filter(keys, bits) == keys).all()
    others = containment.keyed(np.arange(1000, 101_000, dtype=np.uint64), 3)
    assert len(containment.in_filter(others, bits)) < 20


def test_keepers_keep_columns(spark):
    df = awkward(spark)
    first = exact_dedup.keep_first(df)
    assert first.columns == df.columns
    assert Counter(r["doc_id"] for r in first.collect()) == Counter(d for d, _, _, k, _ in brute.exact(AWKWARD) if k)
    one = near_dedup.keep_one(df)
    assert one.columns == df.columns
    assert Counter(r["doc_id"] for r in one.collect()) == Counter(d for d, _, _, k in brute.near(AWKWARD, 5) if k)


def test_memory_of_a_batch(spark):
    """Wide rows reach Python a few megabytes at a time, unless the session has its own
    setting, and near-dedup of them gives the same rows; remembered words are few."""
    import pyarrow as pa

    from tidewater.llm.common import WordHash, map_rows, two_columns

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key, None)
    data = [(i, f"{i % 7} " + " ".join(f"w{i % 7}_{k}" for k in range(20_000))) for i in range(70)]
    try:
        for make in (lambda df: two_columns(df, "doc_id", "text"), lambda df: map_rows(df, lambda batches: batches)):
            spark.conf.unset(key)
            df = make(awkward(spark, data).coalesce(1)).select("doc_id", "text")
            sizes = [r["n"] for r in df.mapInArrow(run, "n long").collect()]
            assert sum(sizes) > 8e6 and max(sizes) < 5e6
        spark.conf.set(key, "1m")
        two_columns(awkward(spark, data), "doc_id", "text")
        assert spark.conf.get(key) == "1m"
        got = near_dedup.near_duplicates(awkward(spark, data).coalesce(1))
        same(table(got, "doc_id", "component_id"), [(i, i % 7) for i in range(70)])
    finally:
        spark.conf.unset(key) if held is None else spark.conf.set(key, held)
    hashes = WordHash()
    words = [b"w%d" % i for i in range(100_000)]
    assert (hashes.array(words) == hashes.array(words)).all() and len(hashes) <= 1 << 16


def test_near_families_and_open_lists(spark):
    """A chain of edits, an original with edited copies, and a passage that many
    texts share, with blocks and sketches small enough to take every path."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(60)]
    data, d = [], 0
    for k in range(40):
        words = list(base)
        for i in rng.choice(60, 2, replace=False):
            words[i] = f"e{k}_{i}"
        data.append((d, " ".join(words)))
        d += 1
    shared = " ".join(f"p{i}" for i in range(40))
    for k in range(40):
        data.append((d, shared + " " + " ".join(f"u{k}_{i}" for i in range(rng.integers(5, 40)))))
        d += 1
    words = [f"c{i}" for i in range(80)]
    for k in range(20):
        words = words[3:] + [f"c{80 + 3 * k + i}" for i in range(3)]
        data.append((d, " ".join(words)))
        d += 1
    df = awkward(spark, data)
    for options in ({}, {"block": 4, "meetings": 1}):
        got = near_dedup.near_duplicates(df, n=4, **options)
        same(table(got, "doc_id", "n_shingles", "component_id", "kept"), brute.near(data, 4))


def test_near_dedup_compares_a_block_in_parts():
    import tracemalloc

    import pyarrow as pa

    class Members:  # stands for the sorted members; gives the function that tasks run
        def repartition(self, *keys):
            return self

        sortWithinPartitions = repartition

        def mapInArrow(self, run, schema):
            return run

    size, k, rng = 2200, 64, np.random.default_rng(3)
    family = rng.permutation(1 << 20)[: 8 * (size + 8)].reshape(-1, 8)
    sets = [np.sort(family[i : i + 8].ravel()).astype(np.int64) + 10 for i in range(size)]  # 8 of 8 rows, one new for each next member
    columns = {
        "value": np.ones(size, np.int64), "i": np.zeros(size, np.int32), "j": np.zeros(size, np.int32),
        "rep": np.arange(size) + 100, "label": np.arange(size) + 100, "block": np.zeros(size, np.int32), "n": np.full(size, k),
    }
    batch = pa.RecordBatch.from_arrays(
        [*map(pa.array, columns.values()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([[1]] * size, pa.list_(pa.int64()))],
        names=[*columns, "sketch", "prefix"],
    )
    run = near_dedup._blocks(Members(), k, 70, 100)
    tracemalloc.start()
    pairs = {p for b in run(iter([batch])) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs == {(100 + i, 101 + i) for i in range(size - 1)}  # 56 of 72 values; two steps on: 48 of 80
    assert peak < 60e6, peak  # 137 MB with all pairs of members at a time


def test_near_dedup_meets_random_members_in_one_pass(spark, monkeypatch):
    words = [f"m{i}" for i in range(60)]
    df = spark.createDataFrame([(i, " ".join([*words[:50], f"x{i}"])) for i in range(30)], "doc_id long, text string")
    seen = []
    verified = near_dedup._verified
    monkeypatch.setattr(near_dedup, "_verified", lambda pairs, *a: (seen.append(pairs), verified(pairs, *a))[1])
    near_dedup.near_duplicates(df)
    shuffles = [p._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for p in seen[:1]]
    assert shuffles[0] <= 5, shuffles  # entries, two kinds of centres, listed members, and distinct pairs


def test_shards(spark):
    data = [(i, "x" * (i % 37) + "\n" * (i % 3)) for i in range(400)] + [(900 + i, "copy") for i in range(300)] + [(None, None)]
    for k in (1, 3, 8):
        out = sharding.with_slots(sharding.kd_shards(awkward(spark, data), shards=k)).collect()
        size, slots = Counter(), defaultdict(list)
        for r in out:
            size[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert len(out) == len(data) and set(size) == set(range(k))
        assert max(size.values()) < 1.1 * min(size.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {d: t or "" for d, t in data}
    assert all(r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in out)
    assert sharding.kd_shards(awkward(spark, [])).count() == 0


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>a</p>", "<p>a</p>", None, "", "é\r\n\r\nx" * 10, "<p>a</p>"]
    data = [(i, f"http://h/{i}\n x", h) for i, h in enumerate(html)] + [(None, None, "<p>a</p>"), (9, "u", "<p>b</p>"), (9, "u", "<p>b</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in data], "page_id long, url string, html string, offset string")
    path = f"file://{tmp_path}/w"
    out = warc.archive_pages(pages, path).collect()
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in out), key=repr)
    want = [(0, "response", None, 8), (1, "revisit", 0, 8), (2, "response", None, 0), (3, "revisit", 2, 0), (4, "response", None, 70),
            (5, "revisit", 0, 8), (9, "response", None, 8), (9, "revisit", 9, 8), (None, "revisit", 0, 8)]
    assert got == sorted(want, key=repr)
    archives = {r["archive"] for r in out}
    for a in archives:  # every member opens at its own offset, and the whole is one valid gzip file
        raw = open(a, "rb").read()
        own = sorted((r["offset"], r["length"]) for r in out if r["archive"] == a)
        assert sum(n for _, n in own) == len(raw)
        assert b"".join(zlib.decompress(raw[o : o + n], 31) for o, n in own) == gzip.decompress(raw)
        assert len(open(a + ".idx").readlines()) == len(own)
    empty = warc.archive_pages(pages.limit(0), f"file://{tmp_path}/e")
    assert empty.count() == 0


def test_lattice_sums_and_samples():
    vocab = pieces.vocabulary(queries.MODEL)
    weights = defaultdict(list)
    for i, s in vocab["surface"].items():
        weights[s].append(float(np.exp(vocab["logp"][i])))
    chunks = [b" hello", b"the", " naïve".encode(), b"   a", "\U0001f600".encode(), b"zzzzzz"]
    lat = pieces.Lattices(pieces.Trie(vocab), chunks)
    totals = lat.totals(lat.forward(vocab["logp"]))
    assert np.allclose(np.exp(totals), [brute.lattice_probability(c, weights) for c in chunks], rtol=1e-9)
    counts = lat.expected(vocab["logp"], np.ones(len(chunks)), vocab["size"])
    assert abs(sum(counts[i] * len(s) for i, s in vocab["surface"].items()) - sum(map(len, chunks))) < 1e-6
    # sampled segmentations follow the paths' weights
    small = encoding.Sampler(vocab, 1.0, 5)
    out = Counter(tuple(x.tolist()) for x in small.encode(list(range(4000)), [b" the"] * 4000))
    p = {path: float(np.exp(sum(vocab["logp"][i] for i in path) - np.log(brute.lattice_probability(b" the", weights)))) for path in out}
    assert all(abs(out[k] / 4000 - p[k]) < 0.04 for k in out)


def test_pieces_round_trip_and_repeat(spark):
    df = awkward(spark)
    a = encoding.sample_pieces(df, queries.MODEL, carry=("n",))
    back = encoding.decode_pieces(a, queries.MODEL)
    got = sorted(((r["doc_id"], r["decoded"]) for r in back.collect()), key=repr)
    assert got == sorted(AWKWARD, key=repr)
    one = table(a, "doc_id", "pieces")
    assert one == table(encoding.sample_pieces(df.repartition(7), queries.MODEL), "doc_id", "pieces")
    assert one != table(encoding.sample_pieces(df, queries.MODEL, seed=1), "doc_id", "pieces")
    assert encoding.sample_pieces(awkward(spark, []), queries.MODEL).count() == 0


@pytest.mark.parametrize("head", [1_000_000, 1])
def test_lm_scores(spark, head):
    data = AWKWARD + [(i, f"alpha beta beta gamma{i}") for i in range(20, 40)]
    out = lm_scoring.lattice_scores(awkward(spark, data), queries.MODEL, head=head).collect()
    want = brute.word_model(data)
    key = lambda r: (repr(r[0]), r[2], r[3], round(r[5], 6))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out]
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5]))
    assert all(r["score"] < 0 for r in out)
    assert lm_scoring.lattice_scores(awkward(spark, []), queries.MODEL).count() == 0


def test_secrets_base_and_layers(spark):
    for d, t in AWKWARD + small(spark)[1][:100]:
        assert secrets.find_secrets(t or "")[0] == brute.base_secrets(t)
    secret = "password=hunter2secret"
    b64 = base64.b64encode(secret.encode()).decode()
    zipped = base64.b64encode(zlib.compress(secret.encode())).decode()
    nested = base64.b64encode(("see " + quote(b64, safe="")).encode()).decode()
    escaped = "".join(f"\\u{ord(c):04x}" for c in secret)
    for inner in (b64, zipped, nested, escaped, quote(secret, safe="").replace("p", "%70")):
        text = f"é {inner} and {inner} end"
        base, added, *_ = secrets.find_secrets(text)
        found = [(a, b) for k, a, b in added if k == "assign"]
        first, second = text.index(inner), text.rindex(inner)
        assert len(found) == 2, (inner, added)
        assert first <= found[0][0] < found[0][1] <= first + len(inner) <= second <= found[1][0] < found[1][1]
    assert secrets.find_secrets("%25" * 50)[2] > 1  # ends
    got = secrets.secret_spans(awkward(spark, [(1, f"x {b64}"), (None, None)])).collect()
    assert len(got) == 2 and secrets.secret_spans(awkward(spark, [])).count() == 0


def secret_at(text, inner, **more):
    """A decoded assignment lies within ``inner``."""
    start = text.index(inner)
    return any(k == "assign" and start <= a < b <= start + len(inner) for k, a, b in secrets.find_secrets(text, **more)[1])


def test_secrets_in_binary_layers():
    secret = b"password=hunter2secret"
    tar = io.BytesIO()
    with tarfile.open(fileobj=tar, mode="w:gz") as t:
        info = tarfile.TarInfo("a")
        info.size = len(secret)
        t.addfile(info, io.BytesIO(secret))
    zipped = gzip.compress(secret + b" and more" * 9)
    for raw in (tar.getvalue(), "é password=hunter2secret ü".encode("latin-1"), bytes(range(256)) + secret + bytes(range(200, 256))):
        inner = base64.b64encode(raw).decode()
        assert secret_at(f"é {inner} end", inner), raw
    hexed = "".join(f"\\x{c:02x}" for c in zipped)
    for inner in (quote(zipped, safe=""), quote_plus(zipped), hexed, repr(zipped), quote(zlib.compress(secret))):
        assert secret_at(f"é {inner} end", inner), inner


def test_secrets_in_wrapped_and_prefixed_base64():
    secret = b"password=hunter2secret"
    lines = base64.encodebytes(b"some settings that are long enough for us passwo" + b"rd=hunter2secret and what follows").decode().strip()
    assert secret_at(f"é\n{lines}\nend", lines)
    zipped = base64.b64encode(gzip.compress(np.random.default_rng(1).bytes(300).hex().encode() + secret)).decode()
    for width, end in ((64, "\n"), (76, "\r\n"), (70, "\n")):
        lines = end.join(zipped[i : i + width] for i in range(0, len(zipped), width))
        assert secret_at(f"é\n{lines}\nend", lines)
    plain = base64.b64encode(secret).decode().rstrip("=")
    for before in ("https://h/v1/", "key_", "k-", "abc", "-----BEGIN KEY-----\n", "word\n"):
        for after in ("", "_suffix", "\nnext", "/x", "abcd"):
            assert secret_at(f"é {before}{plain}{after} end", plain), (before, after)


def test_secrets_in_large_payloads():
    secret = b"password=hunter2secret"
    b64 = lambda raw: base64.b64encode(raw).decode()
    far = b64(gzip.compress(b"0 " * 200_000 + secret + b" 1" * 1000))
    assert secret_at(far, far, limit=1000) and secrets.find_secrets(far, 1000)[3] == 1
    cut = b64(gzip.compress(secret + "é".encode() * 2000))
    assert secret_at(cut, cut, limit=1001)
    members = b64(gzip.compress(b"nothing") + gzip.compress(b"passwo") + gzip.compress(b"rd=hunter2secret"))
    assert secret_at(members, members)
    inner = base64.encodebytes(gzip.compress(np.random.default_rng(2).bytes(20_000) + secret))
    nested = b64(gzip.compress(b"0 " * 20_000 + inner))
    assert secret_at(nested, nested, limit=1000)


def test_toxicity_held_out(spark):
    bad = ["loser", "moron", "scum"]
    rng = np.random.default_rng(1)
    plain = ["garden", "window", "simple", "colour", "paper", "river", "losing", "more", "scrum", "later", "morning"]
    data, labels = [], []
    for i in range(300):
        words = list(rng.choice(plain, 30))
        if i % 4 == 0:
            words[3], words[9] = rng.choice(bad, 2)
        data.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    labels += [(None, 1), (5, None)]
    disguised = [(1000, "simple l0ser paper m0r0n river"), (1001, "you s c u m and l.o.s.e.r"), (1002, "garden moooron window looooser"), (1003, "river garden 2nd paper 10x"), (1004, None), (None, "")]
    df = awkward(spark, data + disguised)
    model = toxicity.fit_toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = {r["doc_id"]: r for r in toxicity.toxicity_scores(df, model).collect()}
    held = [i for i, _ in data if out[i]["held_out"]]
    assert held and all(out[i]["predicted"] == (i % 4 == 0) for i in held)
    assert [out[i]["predicted"] for i in (1000, 1001, 1002, 1003, 1004)] == [1, 1, 1, 0, 0]
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == len(data) + len(disguised) - sum(r["predicted"] for r in out.values())
    none = toxicity.fit_toxicity(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["score"] < 0.01 for r in toxicity.toxicity_scores(df, none).collect())


def test_toxicity_disguises(spark):
    bad, plain = ["loser", "moron", "idiot", "stupid"], ["garden", "looser", "simple", "middle", "paper", "river", "mood", "later", "1.5", "a.m."]
    rng = np.random.default_rng(2)
    data = [(i, " ".join([*rng.choice(plain, 30), *([bad[i // 4 % 4]] if i % 4 == 0 else [])])) for i in range(300)]
    forms = ["iddiot", "stuppid", "mooron", "lo.ser", "st-upid", "i/d/i/o/t", "l  o  s  e  r", "m\to\tr\to\tn", "i\nd\ni\no\nt", "s + u p i d", "m * r * n", "st.uppid"]
    hidden = [(1000 + i, f"simple paper {w} river garden") for i, w in enumerate(forms)]
    clean = [(2000, "simple looser paper"), (2001, "| garden | paper | 1 | 2 |"), (2002, "middle a.m. 1.5 mood")]
    df = awkward(spark, data + hidden + clean)
    model = toxicity.fit_toxicity(df, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in data], "doc_id long, toxic int"))
    out = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity_scores(df, model).collect()}
    assert [t for i, t in hidden if not out[i]] == []
    assert [t for i, t in clean if out[i]] == []


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.sql(queries.ORACLE_SQL[name])
    cols = sorted(want.columns)
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == cols
    same(table(df, *cols), want.select(",".join(cols)).fetchall())


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    docs, data = small(spark)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "sentencepiece"]
    clean = stages["toxicity"](spark, docs, SF_SMALL).cache()
    left = [(r["doc_id"], r["text"]) for r in clean.collect()]
    exact = stages["exact_dedup"](spark, clean, SF_SMALL).cache()
    left = [(d, dict(left)[d]) for d, _, _, k, _ in brute.exact(left) if k]
    same(table(exact, "doc_id", "text"), left)
    near = stages["near_dedup"](spark, exact, SF_SMALL).cache()
    left = [(d, dict(left)[d]) for d, _, _, k in brute.near(left, 5) if k]
    same(table(near, "doc_id", "text"), left)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    fair = stages["decontamination"](spark, near, SF_SMALL)
    leaked = {d for d, *_ in brute.contained(left, items)}
    same(table(fair, "doc_id", "text"), [r for r in left if r[0] not in leaked])
    assert fair.columns == docs.columns
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(d for d, _ in left if d not in leaked)
    assert out.where("NOT lossless").count() == 0
