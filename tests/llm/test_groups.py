"""Near-duplicates, shards, packing and the pipeline against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from llm_rows import PROSE, SPANISH, empty, odd, odd_rows, tables  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import components, packing, queries, sharding, simhash


def brute_print(text):
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """The first member of each print's class; pairs at three or fewer differing bits."""
    prints = np.asarray(prints, np.uint64)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def clustered(seed=1, centres=150):
    rng = np.random.default_rng(seed)
    prints = []
    for base in rng.integers(0, 2**63, centres, dtype=np.uint64):
        prints.append(int(base))
        for _ in range(rng.integers(0, 6)):
            x = prints[-1]
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(bit)
            prints.append(x)
    return np.unique(np.array(prints, np.uint64))


@pytest.mark.parametrize("extra", [0, 2])
def test_ball_hashing_finds_the_components(extra):
    prints = clustered()
    pairs = np.concatenate([simhash.links_in_bucket(prints, b, extra) for b in range(64 << extra)])
    assert (np.bitwise_count(pairs[:, 0].view(np.uint64) ^ pairs[:, 1].view(np.uint64)) <= 3).all()
    root = dict(simhash._forest(pairs).tolist())
    got, expected = defaultdict(set), defaultdict(set)
    for x, r in zip(prints.view(np.int64).tolist(), brute_classes(prints), strict=True):
        got[root.get(x, x)].add(x)
        expected[r].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("bucket_rows", [1 << 21, 40])
def test_links_by_spark(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket_rows)
    prints = clustered(2, 60)
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fingerprint long")
    root = {r.node: r.root for r in components.connected(simhash.links(frame)).collect()}
    ordered = np.sort(prints.view(np.int64))
    expected = [int(ordered[r]) for r in brute_classes(ordered.view(np.uint64))]
    assert [root.get(int(x), int(x)) for x in ordered] == expected


@pytest.mark.parametrize("share", [2, 30, 10**6])
def test_components_with_hot_centres(spark, monkeypatch, share):
    monkeypatch.setattr(components, "HOT_SHARE", share)
    rng = np.random.default_rng(share)
    edges = [(0, int(x)) for x in rng.integers(1, 400, 300)] + [(500 + i % 7, 900 + i) for i in range(200)]
    edges += [(int(a), int(b)) for a, b in rng.integers(2000, 2300, (120, 2))]
    root = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {n: r for n, r in root.items()} == {n: find(n) for a, b in edges if a != b for n in (a, b)}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100)], "a long, b long")
    got = {r.node: r.root for r in components.connected(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100}


def test_near_duplicates(spark, odd, empty, tables):
    near = [(20 + i, PROSE + f" {w}", "en", "a", 1, "k", "i", "r") for i, w in enumerate(("Then", "it", "rained."))]
    docs = odd.unionByName(spark.createDataFrame(near, odd.schema))
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    classes = brute_classes(prints)
    least = defaultdict(list)
    for r, c in zip(rows, classes, strict=True):
        least[c] += [r.doc_id] * (r.doc_id is not None)
    got = queries.QUERIES["op2_simhash"](spark, tables(documents=docs)).collect()
    expected = Counter(
        (r.doc_id, format(p, "016x"), min(least[c], default=None)) for r, p, c in zip(rows, prints, classes, strict=True)
    )
    assert Counter(tuple(r) for r in got) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(classes))
    assert kept.where("doc_id = 1").count() == 1 and kept.where("doc_id = 2").count() == 0
    assert simhash.components(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_hot_fingerprint_is_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(i, PROSE if i % 2 else PROSE + SPANISH * (i % 5)) for i in range(60)], "doc_id long, text string")
    expected = sorted(simhash.components(docs).collect())
    monkeypatch.setattr(simhash, "HOT_SHARE", 1)
    assert sorted(simhash.components(docs).collect()) == expected


def test_shards(spark, odd, empty, tables):
    rows = [(i, "copy of one text" if i % 3 == 0 else f"text {i} " * (i % 40)) for i in range(3000)]
    rows += [(None, None), (None, ""), (5, "tie"), *[(7, "tie")] * 400]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = queries.QUERIES["op9_sharding"](spark, tables(documents=docs)).collect()
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert sorted(sizes) == list(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 0.05 * sum(sizes.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.by_bytes(empty).count() == 0
    whole = sharding.shard_documents(odd)
    assert whole.columns == [*odd.columns, "shard", "slot"] and whole.count() == odd.count()


def test_shards_are_native(spark, odd):
    plan = sharding.by_bytes(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def brute_best_fit(lengths, width):
    free, used = [], Counter()
    for x in lengths:
        fits = [(f, i) for i, f in enumerate(free) if f >= x]
        if not fits:
            free.append(width)
        i = min(fits)[1] if fits else len(free) - 1
        free[i] -= x
        used[i] += x
    return sorted(used.values())


@pytest.mark.parametrize("width", [1, 5, 64, 100])
def test_best_fit(width):
    rng = np.random.default_rng(width)
    lengths = sorted(rng.integers(1, width + 1, 400).tolist(), reverse=True)
    used = Counter()
    for row, x in zip(packing.best_fit(lengths, width), lengths, strict=True):
        used[row] += x
    assert sorted(used.values()) == brute_best_fit(lengths, width)
    assert packing.best_fit([], width) == []


def test_packing_round_trip(spark, odd, empty, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = packing.pack_documents(odd, path, public_tokenizers.PATTERN, width=128, group_bytes=40_000)
    packing.write_packed(rows, f"{tmp_path}/packed")
    pieces = defaultdict(list)
    for r in spark.read.parquet(f"{tmp_path}/packed").collect():
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) == 128 and r.cu_seqlens[-1] == r.n_tokens <= 128
        for s, start, end in zip(r.segments, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert (s.start, s.start + s.n_tokens) == (start, end)
            assert positions[start:end].tolist() == list(range(end - start))
            pieces[s.doc_id, s.segment].append((s.n_segments, ids[start:end].tolist()))
    encoding = packing.load_encoding(path, public_tokenizers.PATTERN)
    expected = defaultdict(list)
    for doc_id, text, *_ in odd_rows():
        ids = [*encoding.encode_ordinary(text or ""), packing.END_ID]
        for k, at in enumerate(range(0, len(ids), 128)):
            expected[doc_id, k].append((-(-len(ids) // 128), ids[at : at + 128]))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    assert packing.pack_documents(empty, path, public_tokenizers.PATTERN).count() == 0


def check_packing(spark, folder, rows):
    """Every digest of the query, made again from the segments that it places."""
    got = queries.QUERIES["op6_packing"](spark, folder).collect()
    encoding = packing.load_encoding(queries.TOKEN_RANKS, public_tokenizers.PATTERN)
    sha = lambda array: hashlib.sha256(array.tobytes()).hexdigest()
    expected, by_digest = Counter(), {}
    for doc_id, text in rows:
        ids = np.array([*encoding.encode_ordinary(text or ""), packing.END_ID], "<u2")
        for k, at in enumerate(range(0, len(ids), packing.WIDTH)):
            part = ids[at : at + packing.WIDTH]
            expected[doc_id, k, len(part), sha(part)] += 1
            by_digest[sha(part)] = part
    assert Counter((r.doc_id, r.segment, r.n_tokens, r.ids_sha256) for r in got) == expected
    inside = defaultdict(list)
    for r in got:
        inside[r.pack_group, r.pack_row].append(r)
    for members in inside.values():
        ids, positions, lengths = np.full(packing.WIDTH, packing.END_ID, "<u2"), np.zeros(packing.WIDTH, "<u4"), [0]
        for r in sorted(members, key=lambda r: r.start):
            assert r.start == lengths[-1]
            lengths.append(r.start + r.n_tokens)
            ids[r.start : lengths[-1]] = by_digest[r.ids_sha256]
            positions[r.start : lengths[-1]] = np.arange(r.n_tokens)
        digests = (sha(ids), sha(np.array(lengths, "<i4")), sha(positions))
        assert {(r.row_sha256, r.cu_seqlens_sha256, r.positions_sha256) for r in members} == {digests}
    return got


def test_packing_query(spark, odd, tables):
    check_packing(spark, tables(documents=odd), [(r[0], r[1]) for r in odd_rows()])


def test_packing_of_whole_table(spark, data_dir):
    rows = [tuple(r) for r in queries.table(spark, data_dir, "documents").select("doc_id", "text").collect()]
    got = check_packing(spark, data_dir, rows)
    tokens = sum(r.n_tokens for r in got)
    packed = len({(r.pack_group, r.pack_row) for r in got})
    groups = len({r.pack_group for r in got})
    assert packed <= tokens // packing.WIDTH + 1 + groups + 0.02 * packed


def test_equal_and_empty_rows_spread_over_groups(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for text, kind in ((PROSE, "long"), (None, "string")):
        docs = spark.range(3000).select(F.lit(None).cast(kind).alias("doc_id"), F.lit(text).cast("string").alias("text"), F.lit(1).alias("ids"))
        size = 3000 * (packing.ROW_BYTES + len((text or "").encode()))
        rows = packing.pack_documents(docs, path, public_tokenizers.PATTERN, group_bytes=size // 27 + 1)
        counts = Counter()
        for r in rows.select("pack_group", F.size("segments").alias("n")).collect():
            counts[r.pack_group] += r.n
        assert len(counts) == 27 and sum(counts.values()) == 3000 and max(counts.values()) < 200


def test_pipeline(spark, odd, tables):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    item = "when the seventh lantern failed the keeper climbed the narrow stair and counted every gull upon the rail"
    more = [
        (30, PROSE + "\nAbout | News | Help | Login | Cart", "en", "a", 1),
        (31, SPANISH + " " + item + ".", "es", "a", 1),
        (32, SPANISH.replace("río", "lago") + " password=abcdef1234567890 fin.", "es", "a", 1),
    ]
    docs = odd.select(*names).unionByName(spark.createDataFrame(more, odd.select(*names).schema))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    folder = tables(documents=docs, benchmark=bench)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, frame, folder).write.parquet(f"{folder}/{name}")
        frame = spark.read.parquet(f"{folder}/{name}")
        assert frame.dtypes == docs.dtypes
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert 31 not in texts and 30 not in texts and 2 not in texts and texts[1] == PROSE
    assert "password=[SECRET] fin." in texts[32]
    got = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in got.collect()) == sorted(texts)
    digest = {r.doc_id: r.decoded_sha256 for r in got.select("doc_id", F.col("decoded_sha256")).collect()}
    assert digest == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}
