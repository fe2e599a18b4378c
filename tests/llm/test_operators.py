"""The operators against brute force, exact round trips and held-out labels, and their edge cases."""

import hashlib
import io
import random
import zipfile
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillstone.llm import chat, common, decontam, htmltext, licences, media, neartext, packing, sharding, simhash, toxicity, warc

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, fp long, id string, _part int"


def docs(spark, texts, ids=None):
    """Documents with extra columns whose names clash with the operators' own."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", 1, "x", 2) for i, t in zip(ids, texts, strict=True)], DOC)


def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


EDGE = [None, "", " \n\t ", "one", "one two", "Ünïcode \U0001f600 text", "same text here", "same text here", "x" * 50_000, "a b c " * 20_000]


# --- 1 ------------------------------------------------------------------------


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_classes(fps, radius=3):
    up = list(range(len(fps)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_simhash_equals_brute_force(spark):
    df = real(spark).unionByName(docs(spark, EDGE, range(10_000, 10_000 + len(EDGE))).select("doc_id", "text"), allowMissingColumns=True)
    rows = df.orderBy("doc_id").collect()
    want = [slow_fingerprint(r.text) if len(r.text or "") < 60_000 else simhash.fingerprint(r.text) for r in rows]
    got = {r.id: (r.fp % 2**64, r.component) for r in simhash.near_duplicates(df).collect()}
    assert [got[r.doc_id][0] for r in rows] == want
    assert [got[r.doc_id][1] for r in rows] == [rows[k].doc_id for k in slow_classes(want)]


@pytest.mark.parametrize("bits", [8, 4, 2, 1])
def test_search_of_any_width_finds_all(spark, bits):
    rng = random.Random(bits)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in list(fps):
        for _ in range(2):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << b
            fps.append(f)
    fps = sorted(set(fps))
    nodes = spark.createDataFrame([(f - 2**64 if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    found = {r.node: r.component for r in common.components(simhash.links(nodes, 3, bits), "a", "b").collect()}
    assert [found.get(i, i) for i in range(len(fps))] == slow_classes(fps)


@pytest.mark.parametrize("limit", [10, 100, 10_000])
def test_cells_of_crowded_shards_find_all(spark, limit):
    """A third of the fingerprints lie within a few bits of one, so that they crowd a few shards."""
    rng = random.Random(limit)
    fps, middle = {rng.getrandbits(64) for _ in range(200)}, rng.getrandbits(64)
    while len(fps) < 300:
        fps.add(middle ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - 2**64 if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    found = {r.node: r.component for r in common.components(simhash.links(nodes, 3, 8, limit), "a", "b").collect()}
    assert [found.get(i, i) for i in range(len(fps))] == slow_classes(fps)


def test_cells_hold_every_two_rows(spark):
    keys = [0] * 90 + [1] * 9 + [2] * 40
    rows = spark.createDataFrame(list(enumerate(keys)), "rep long, shard long")
    sizes = rows.groupBy("shard").count().withColumnRenamed("count", "n")
    held = defaultdict(set)
    for r in common.in_cells(rows, sizes, "shard", "rep", 20).collect():
        held[r.shard, r.cell].add(r.rep)
    assert len([1 for key, _ in held if key == 1]) == 1
    assert max(map(len, held.values())) <= 40
    together = {(a, b) for own in held.values() for a in own for b in own}
    assert together == {(a, b) for a, x in enumerate(keys) for b, y in enumerate(keys) if x == y}


def test_simhash_edges(spark):
    none = simhash.near_duplicates(docs(spark, [])).collect()
    assert none == []
    got = simhash.near_duplicates(docs(spark, ["a b c", "a b c", None, ""], [5, None, 7, None])).collect()
    assert sorted(((r.id, r.component) for r in got), key=str) == [(5, 5), (7, 7), (None, 5), (None, 7)]


# --- 2 ------------------------------------------------------------------------


def slow_texts(texts):
    """The smallest index reachable over links of a Jaccard similarity of 0.8 or more, by all pairs that share a shingle."""
    sets = [decontam.shingles_of(decontam.words_of(t)) for t in texts]
    root, holders = list(range(len(sets))), defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first_empty = next((i for i, s in enumerate(sets) if not s), None)
    for i, own in enumerate(sets):
        shared = defaultdict(int)
        for s in own:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        near = [j for j, n in shared.items() if n >= 0.8 * (len(own) + len(sets[j]) - n) - 1e-9] if own else [first_empty]
        for j in near:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("limit", [neartext.CELL, 30])
def test_near_texts_equal_brute_force(spark, limit):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [None, "", " ", "two words", "Two  Words", "one"]
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([40, 120, 400]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 60)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    got = {r.id: r.component for r in neartext.near_texts(docs(spark, texts), limit=limit).collect()}
    assert [got[i] for i in range(len(texts))] == slow_texts(texts)


def edited(rng, base, share):
    """The words with so large a share of them replaced, each by a word of its own."""
    out = list(base)
    for i in rng.sample(range(len(base)), round(share * len(base))):
        out[i] = f"v{rng.randrange(10**9)}"
    return " ".join(out)


def test_near_texts_joins_a_large_group_of_edited_copies(spark):
    """Copies at 0.82 of a base and below 0.8 of each other: one class, though sketches of copies are often closest."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    texts = [" ".join(base)] + [edited(rng, base, 0.02) for _ in range(400)]
    got = {r.id: r.component for r in neartext.near_texts(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == slow_texts(texts)


@pytest.mark.parametrize("limit", [neartext.CELL, 30])
def test_links_beyond_the_trees(spark, monkeypatch, limit):
    """The same classes if no pair is found in a tree, so with any sketch."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(3000)}" for _ in range(60)]
    texts = [" ".join(base)] + [edited(rng, base, 0.02) for _ in range(60)]
    monkeypatch.setattr(neartext, "BANDS", (-1.0,))
    got = {r.id: r.component for r in neartext.near_texts(docs(spark, texts), limit=limit).collect()}
    assert [got[i] for i in range(len(texts))] == slow_texts(texts)


@pytest.mark.parametrize("shape", [(16, 16, 2), (32, 24, 1)])
def test_short_near_texts_in_every_shape(spark, monkeypatch, shape):
    """Eight words and the same with one more are at 0.8 exactly, often with sketches far apart."""
    rng = random.Random(13)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(8)) for _ in range(100)]
    texts += [f"{t} more{i}" for i, t in enumerate(texts)]
    monkeypatch.setattr(neartext, "SHAPES", ((None, *shape),))
    got = {r.id: r.component for r in neartext.near_texts(docs(spark, texts)).collect()}
    assert [got[i] for i in range(200)] == [*range(100)] * 2


@pytest.mark.parametrize(("trees", "width", "level"), [(16, 16, 8), (16, 16, 2), (32, 24, 1)])
def test_each_shape_finds_the_pairs_that_meet(spark, trees, width, level):
    """Sketches within the first band link if a block of theirs is within one bit, whatever the levels."""
    rng = np.random.default_rng(level)
    base = rng.integers(0, 256, (40, trees * width // 8), np.uint8)
    near = base.copy()
    near[:, 0] ^= 1
    near[:, -1] ^= 0x80
    nodes = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(np.concatenate([base, near]))], "rep long, sketch binary")
    got = {(r.a, r.b): r.h for r in neartext.candidates(nodes, trees, width, level).collect()}
    assert got == {(i, i + 40): 2 for i in range(40)}
    sizes = {r.shard: r.n for r in neartext.shard_sizes(nodes, trees, width, level).collect()}
    assert sizes == {r["shard"]: r["count"] for r in neartext.placed(nodes, trees, width, level).groupBy("shard").count().collect()}


def test_pairs_that_parities_rule_out_are_not_made(spark):
    """A group whose texts share three shingles in four: every two have first shingles in common, but none is a near duplicate."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(60):
        words = list(base)
        for i in rng.sample(range(150), 9):
            words[i] = f"v{k}x{i}"
        texts.append(" ".join(words))
    near = [" ".join([*base[:149], f"end{k}"]) for k in range(4)]
    own = spark.createDataFrame(list(enumerate([*texts, *near])), "id long, text string").withColumn("c", F.col("id"))
    rows = neartext.sharing(own, np.zeros(neartext.COUNTERS, np.int64), 5, 0.8).collect()
    sets = [decontam.shingles_of(decontam.words_of(t), 5) for t in (*texts, *near)]
    alike = {(i, j) for j in range(64) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert alike >= {(i, j) for j in range(60, 64) for i in range(60, j)} and alike <= {(r.a, r.b) for r in rows}
    assert len(rows) < 64 * 63 // 2


def test_parities_never_differ_in_more_bits_than_shingles():
    rng = np.random.default_rng(3)
    for n in (1, 5, 100, 3000):
        values = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
        for cut in {0, 1, n // 10, n}:
            other = values[cut:]
            assert np.bitwise_count((neartext.parities(values) ^ neartext.parities(other)).view(np.uint64)).sum() <= cut


def test_parted_leaves_little_to_join(spark):
    rows = spark.createDataFrame([(i if i % 7 else None, "x", i) for i in range(3000)], "id int, `a.b` string, _word long")
    ids = spark.createDataFrame([(i,) for i in range(0, 6000, 50)], "id long")
    for bits in (64, 1 << 24):
        away, rest = common.parted(rows, ids, "id", bits)
        assert away.columns == rest.columns == rows.columns
        assert sorted(r["_word"] for r in away.unionByName(rest).collect()) == list(range(3000))
        assert away.where("id is not null and id % 50 = 0").isEmpty() and rest.where("id is null").isEmpty()
    assert rest.count() < 60


def test_components_write_few_files(spark, monkeypatch):
    written, kept = [], common.stash
    monkeypatch.setattr(common, "stash", lambda df, name, **o: [out := kept(df, name, **o), written.append((name, len(out.inputFiles())))][0])
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
        assert {r.component for r in common.components(edges, "a", "b").collect()} == {0}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert {n for name, n in written if name.endswith("-star")} == {1}


def test_near_texts_edges(spark):
    assert neartext.near_texts(docs(spark, [])).collect() == []
    got = neartext.near_texts(docs(spark, ["a b c", "a b c", None, "", "z"], [5, None, 7, 7, None])).collect()
    assert sorted((r.id is None, r.id or 0, r.component or 0) for r in got) == [(False, 5, 5), (False, 7, 7), (False, 7, 7), (True, 0, 0), (True, 0, 5)]


@pytest.mark.parametrize("width", [16, 24])
def test_blocks_that_meet(width):
    rng = np.random.default_rng(2)
    block = rng.integers(0, 1 << width, 300)
    block[150:] = block[:150] ^ (1 << rng.integers(0, width, 150))
    visit = rng.integers(0, 2, 300).astype(np.int32)
    pairs = {tuple(sorted((int(i), int(j)))) for a, b in neartext._meeting(block, visit, width) for i, j in zip(a, b)}
    near = {(i, j) for i in range(300) for j in range(i) if not (visit[i] and visit[j]) and int(block[i] ^ block[j]).bit_count() <= 1}
    assert pairs == {(j, i) for i, j in near}


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chats_collapse(spark):
    a = [("user", "hi"), ("assistant", "yes?"), ("user", None)]
    rows = [(1, i, *t) for i, t in enumerate(a[:1])] + [(2, i, *t) for i, t in enumerate(a)] + [(3, i, *t) for i, t in enumerate(a[:2])] + [(4, i, *t) for i, t in enumerate(a)] + [(5, 0, "user", "other"), (None, 0, None, "x")]
    got = {r.conv: r for r in chat.format_chats(chats(spark, rows)).collect()}
    assert set(got) == {2, 5, None} and got[2].collapsed == 1 and got[2].turns == 3
    assert got[2].text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes?<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert chat.format_chats(chats(spark, [])).count() == 0


def test_a_conversation_over_many_partitions(spark):
    rows = [(7, i, "user", f"t{i}") for i in range(3000)] + [(8, i, "user", f"t{i}") for i in range(1700)] + [(9, i, "user", f"u{i}") for i in range(50)]
    got = chat.format_chats(chats(spark, rows), chunk=1000).orderBy("conv", "chunk").collect()
    assert [(r.conv, r.turns, r.chunk) for r in got] == [(7, 3000, 0), (7, 3000, 1), (7, 3000, 2), (9, 50, 0)]
    assert got[1].text.startswith("<|im_start|>user\nt1000<")


# --- 3 ------------------------------------------------------------------------


def test_encoder_equals_whole_texts():
    encode = packing.encoder(None)
    odd = ["  two  spaces ", "a\n\n b\n", "tab\t x", "it's we'll 'd", "é  x 中文 字   y", "", " ", "\n", "\x1c a \x1d", "<|endoftext|> a", "\U0001f600 z", "a" * 500 + " b", "١٢ ½ x²", "a \u0085b", "a\r\n b"]
    assert encode(odd) == encode.whole(odd)


def test_packing_is_exact(spark):
    df = real(spark).select("doc_id", "text").unionByName(docs(spark, EDGE, [None, *range(10_001, 10_000 + len(EDGE))]).select("doc_id", "text"))
    got = packing.pack(common.stash(packing.pieces(df), "pieces"), per_partition=64).collect()
    ids = {r.doc_id: packing.encoder(None).whole([r.text or ""])[0] + b"\0" * 4 for r in df.collect()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
    assert {d: sum(r.length for r in rs) for d, rs in by_doc.items()} == {d: len(x) // 4 for d, x in ids.items()}
    for rs in by_doc.values():
        rs.sort(key=lambda r: r.piece)
        assert [r.start for r in rs] == list(np.cumsum([0, *(r.length for r in rs[:-1])])) and all(r.length == 2048 for r in rs[1:])
    for rs in by_seq.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == list(np.cumsum([0, *(r.length for r in rs[:-1])])) and sum(r.length for r in rs) <= 2048
    assert len(by_seq) <= packing.lower_bound(np.array([r.length for r in got]), 2048) + 3
    assert packing.pack(packing.pieces(docs(spark, []))).count() == 0


def test_bounds_never_exceed_a_packing():
    rng = np.random.default_rng(0)
    for _ in range(60):
        sizes = rng.integers(1, 101, rng.integers(1, 60))
        where, free = packing.best_fit(sizes, 100)
        assert packing.lower_bound(sizes, 100) <= len(free) and (np.bincount(where, sizes) <= 100).all()
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3 and packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]


# --- 4 ------------------------------------------------------------------------


def test_leaks_equal_brute_force(spark):
    rng = random.Random(1)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 40))
    items = [" ".join(word() for _ in range(n)) for n in (5, 7, 12, 20, 33, 60)] + ["Short One", None, "", "   "]
    texts = []
    for t in items[:7]:
        for edits in (0, 1, 2, 4):
            w = t.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join([word() for _ in range(rng.randint(0, 3000))] + w + [word() for _ in range(50)]).upper())
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for i, t in enumerate(items):
        s = decontam.shingles_of(decontam.words_of(t))
        for d, x in enumerate(texts):
            w = decontam.words_of(x)
            own = decontam.shingles_of(w, min(5, len(decontam.words_of(t)))) if s else set()
            if s and len(s & own) >= 0.8 * len(s):
                want.add((d, i, len(s), len(s & own)))
    for block in (decontam.BLOCK, 60):
        got = decontam.leaks(docs(spark, texts + EDGE, [*range(len(texts)), *range(900, 900 + len(EDGE))]), bench, block=block)
        assert {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got.collect()} == want
    assert len(want) >= 10  # the fixture holds whole, edited and short leaks
    kept = decontam.without_leaks(docs(spark, texts + EDGE), bench)
    assert kept.count() == len(texts) + len(EDGE) - len({d for d, *_ in want}) and kept.columns == docs(spark, []).columns
    assert decontam.leaks(docs(spark, texts), bench.limit(0)).count() == 0 and decontam.leaks(docs(spark, []), bench).count() == 0


# --- 5 ------------------------------------------------------------------------


def test_media_round_trip(spark):
    shared = "".join(random.Random(3).choices("abcdefgh \n", k=60_000))
    texts = EDGE + [shared, "x" + shared, shared[:30_000] + "middle" + shared[30_000:], "y" * 192]
    got = {r.id: r for r in media.media_features(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, payload = media.padded(t)
        r = got[i]
        assert len(payload) % 192 == 0 and len(payload) >= max(192, n)
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32, r.feature) == (n, len(payload), zlib.crc32(payload[-16:]), media.feature(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.media_sha256 == hashlib.sha256(media.wav(payload)).hexdigest()
    stored, chunks = media.store(docs(spark, texts))
    bytes_stored = sum(len(c.data or b"") for r in stored.collect() for c in r.chunks) + sum(len(r.data) for r in chunks.collect())
    parts = {m[a:b] for t in texts for m in [media.wav(media.padded(t)[1])] for e in [media.cuts(m)] for a, b in zip([0, *e], e, strict=False)}
    assert bytes_stored == sum(map(len, parts)) < sum(len(media.wav(media.padded(t)[1])) for t in texts) - 50_000  # each chunk is stored once
    assert media.media_features(docs(spark, [])).count() == 0


def test_cuts_follow_content():
    data = random.Random(5).randbytes(400_000)
    ends = media.cuts(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= media.MAX and (sizes[:-1] >= media.MIN).all() and media.cuts(b"") == []
    shifted = {data[a:b] for a, b in zip([0, *ends], ends, strict=False)} & {(b"12345" + data)[a:b] for e in [media.cuts(b"12345" + data)] for a, b in zip([0, *e], e, strict=False)}
    assert len(shifted) > 0.9 * len(ends)


# --- 6 ------------------------------------------------------------------------


def test_main_text():
    page = """<html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header><nav><a href=/>Home</a></nav><div class="ad">Buy</div>
      <article><h1>A  title</h1><p><b>Bold &amp; x<br><p>Next&nbsp;line</p><p>Hi.</p><pre>a <i>b</i>
      c</pre></article><div class=comments><p>Nice post, I liked every word of it very much indeed</p></div><form>q<input></form><footer>(c)</footer>"""
    assert htmltext.main_text(page) == "A title\nBold & x\nNext line\nHi.\na b c"
    plain = "<body><div id=sidebar>Links</div><div><h1>Head</h1><p>%s</p><p>%s</p></div><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul><p>tiny</p></body>" % ("long text " * 20, "more text " * 20)
    assert htmltext.main_text(plain) == "Head\n" + ("long text " * 20).strip() + "\n" + ("more text " * 20).strip()
    assert [htmltext.main_text(x) for x in (None, "", "<", "<p", "</", "<!--", "plain", "<article></article>")][:3] == ["", "", "<"] and htmltext.main_text("a < b & c") == "a < b & c"


def test_bodies_select_the_lines_of_a_page_with_an_article(spark, monkeypatch):
    page = "<p>before</p><article><h1>A</h1><p>b</p><div class=ad>buy</div><aside>x</aside><p>c</p></article><p>between</p><nav>n</nav><article><p>d</p></article><p>after</p>"
    pages = [page, *(r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect() if r.html)]
    want = [htmltext.main_text(p) for p in pages]
    assert want[0] == "A\nb\nc\nd"
    monkeypatch.setattr(htmltext, "bodies", lambda weight, *_, **__: [(0, len(weight))])
    assert not [p for p, t in zip(pages, want, strict=True) if t and htmltext.main_text(p) == t]


def test_main_text_between_bodies_of_a_page_without_an_article():
    long = ("long text " * 300).strip()
    talk = [f"Line {i}, she said." for i in range(8)]
    menu = "<ul>" + "".join(f"<li class=ad>Buy {i}</li>" for i in range(5)) + "</ul>"
    close = ("the end " * 50).strip()
    page = f"<body><div><p>{long}</p>{''.join(f'<p>{t}</p>' for t in talk)}{menu}<p><a href=x>A linked paragraph</a></p><p>{close}</p></div></body>"
    assert htmltext.main_text(page) == "\n".join([long, *talk, "A linked paragraph", close])


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "<article><p>é</p></article>", "x")], "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in htmltext.extract(df).collect())
    assert got == [("1", "", 0), ("1", "", 0), ("None", "é", 1)] and htmltext.extract(df.limit(0)).count() == 0


# --- 7 ------------------------------------------------------------------------


def test_licences_equal_brute_force(spark):
    texts = ["Prose first.\nReleased under the MIT License.\nmore", "licensed under the apache license version 2.0", "Licensed under CC BY 4.0", None, "", "\n\n", "license", *EDGE, "All rights reserved.", licences.TEMPLATES["MIT-grant"] + " Thanks", "\n".join(licences.TEMPLATES["MIT-grant"].split(" "))]
    want = set()
    for d, t in enumerate(texts):
        lines = (t or "").split("\n")
        for n, unit in [(0, t)] * (len(lines) > 1) + list(enumerate(lines, 1)):
            b = set(licences.bigrams_of(unit or ""))
            scored = sorted((-2 * len(b & s) / (len(b) + len(s)), name) for name, x in licences.TEMPLATES.items() for s in [set(licences.bigrams_of(x))]) if b else []
            if scored and scored[0][0] <= -0.8:
                want.add((d, n, scored[0][1], round(-scored[0][0], 9)))
    got = {(r.doc_id, r.line, r.licence, round(r.dice, 9)) for r in licences.scan(docs(spark, texts)).collect()}
    assert got == want and len(want) >= 6
    assert licences.scan(docs(spark, [])).count() == 0
    assert licences.scan(docs(spark, ["All rights reserved."] * 2, [None, None])).count() == 2


def test_licences_within_longer_texts(spark):
    def wrapped(name, at=9):
        w = licences.TEMPLATES[name].split(" ")
        return "\n".join("# " + " ".join(w[i : i + at]) for i in range(0, len(w), at))

    prose = " ".join(f"prose{i}" for i in range(300))
    long = ["Apache-2.0-header", "MIT-grant", "MIT-warranty", "BSD-grant", "ISC-grant", "MPL-2.0", "GPL-or-later"]
    texts = [f"{prose}\n{wrapped(name)}\n{prose}" for name in long] + [f"{prose} Licensed under CC BY 4.0.", f"{wrapped('MIT-grant')}\n{prose}\n{wrapped('MIT-grant')}", prose]
    got = sorted((r.doc_id, r.line, r.licence) for r in licences.scan(docs(spark, texts)).where("dice = 1").collect())
    want = [(i, 2, name) for i, name in enumerate(long)] + [(7, 1, "CC-BY-4.0")]
    want += [(8, 1, "MIT-grant"), (8, 2 + wrapped("MIT-grant").count("\n") + 1, "MIT-grant")]
    assert got == sorted(want)


# --- 8 ------------------------------------------------------------------------


def test_toxicity_held_out_and_disguised(spark):
    rng = random.Random(2)
    good = [f"{a}{b}" for a in ("tion", "ment", "ster", "lo", "ri", "moon", "stu") for b in ("al", "er", "ing", "son", "pin", "id")]
    bad = ["idiot", "stupid", "moron", "scum"]
    texts, labels = [], []
    for i in range(600):
        words = [rng.choice(good) for _ in range(rng.randint(1, 80))]
        if i % 5 == 0:
            words.insert(0, rng.choice(bad))
        texts.append(" ".join(words))
        labels.append((i, int(i % 5 == 0)))
    df, lab = docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")
    scorer = toxicity.fit(df, lab)
    held = [(scorer.score(texts[i]), y) for i, y in labels if toxicity.is_held_out(i)]
    assert np.mean([(s >= 0.7) == bool(y) for s, y in held]) > 0.97
    for t in ("you 1d10t there", "such a s t u p i d thing", "m0r0n", "stuuupid", "i.d.i.o.t"):
        assert scorer.score(t) >= 0.7, t
    for t in EDGE[:-2]:
        assert 0 <= scorer.score(t) < 0.7
    flipped = spark.createDataFrame([(i, 1 - y if toxicity.is_held_out(i) else y) for i, y in labels], "doc_id long, toxic int")
    assert toxicity.fit(df, flipped).score(texts[0]) == scorer.score(texts[0])  # held-out labels are not read
    scored = toxicity.with_score(docs(spark, EDGE), scorer)
    assert scored.count() == len(EDGE) and toxicity.with_score(docs(spark, []), scorer).count() == 0
    assert toxicity.fit(df, lab.limit(0)).score("x") == 0.5 and toxicity.fit(docs(spark, []), lab).score("x") == 0.5


def test_toxicity_of_long_disguises(spark):
    rng = random.Random(3)
    good = "you are such an and the people here know it well when they talk about moon river table garden window".split()
    texts, labels = [], []
    for i in range(900):
        words = [rng.choice(good) for _ in range(rng.randint(5, 60))]
        if i % 5 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron"]))
        texts.append(" ".join(words))
        labels.append((i, int(i % 5 == 0)))
    scorer = toxicity.fit(docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    phrase = "you are such an {} and the people here know it well when they talk about it"
    for bad, score in (("idiot", True), ("garden", False)):
        words = phrase.format(bad).split()
        for t in (" ".join("".join(words)), ".".join("".join(words)), "-".join(words), " ".join("".join(words * 5)), bad[:2] + bad[2] * 60 + bad[3:]):
            assert (scorer.score(f"moon {t} river") >= 0.7) == score, t


# --- 9 ------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    page = ["<p>a</p>", "<p>b</p>", "<p>a</p>", None, "", "<p>a</p>", "é" * 10_000]
    df = spark.createDataFrame([(i, f"http://x/{i}\n", h) for i, h in enumerate(page)] + [(None, None, "<p>a</p>")], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(warc.write(df, folder), folder).collect()), key=str)
    refers = {0: 5, 2: 5, 3: 4}
    want = []
    for i, h in [*enumerate(page), (None, "<p>a</p>")]:
        raw = (h or "").encode()
        want.append((i, len(raw), warc.payload_digest(raw), "revisit" if i in refers else "response", refers.get(i)))
    assert got == sorted(want, key=str)
    assert warc.payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    empty = f"file://{tmp_path}/e"
    assert warc.read(warc.write(df.limit(0), empty), empty).count() == 0
    least = f"file://{tmp_path}/l"
    assert warc.read(warc.write(df, least, least=9), least).where("record_type = 'revisit'").count() == 0


class Bytes(io.BytesIO):
    def read_at(self, n, offset):
        return self.getvalue()[offset : offset + n]


@pytest.mark.parametrize("wide", [True, False])
def test_zip_directories(wide):
    raw = b"".join(warc.zip_archive([(warc.DATA, b"abc"), ("é.txt", b"x" * 1000)], wide))
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.namelist() == [warc.DATA, "é.txt"] and z.read(warc.DATA) == b"abc" and z.testzip() is None
    a = warc.Archive(Bytes(raw), len(raw))
    assert a.at(*a.locate("é.txt")) == b"x" * 1000
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.comment = b"PK\5\6 in a comment"
        z.writestr("s", b"stored")
        z.writestr("d", b"deflated" * 9, zipfile.ZIP_DEFLATED)
    a = warc.Archive(Bytes(buf.getvalue()), len(buf.getvalue()))
    assert a.at(*a.locate("s")) == b"stored"
    with pytest.raises(ValueError):
        a.locate("d")
    with pytest.raises(ValueError):
        warc.Archive(Bytes(b"no zip"), 6)


# --- 10 -----------------------------------------------------------------------


def test_sharding_keeps_counts_and_groups(spark):
    texts = [f"text {i}" for i in range(700)] + ["big"] * 400 + [f"pair {i // 3}" for i in range(90)] + EDGE
    placed = sharding.assign(docs(spark, texts), shards=8)
    rows = placed.collect()
    assert len(rows) == len(texts)
    counts = defaultdict(list)
    for r in rows:
        counts[r.shard].append(r.slot)
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
    assert set(counts) == set(range(8)) and max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    homes = defaultdict(set)
    for r in rows:
        homes[texts[r.doc_id]].add(r.shard)
    assert np.mean([len(homes[f"pair {i}"]) for i in range(30)]) < 1.2 and len(homes["big"]) <= 8
    assert sharding.assign(docs(spark, [])).count() == 0
    few = sharding.assign(docs(spark, ["a", "a", None], [None, 1, 1])).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0]


def test_quotas_balance():
    rng = np.random.default_rng(1)
    for _ in range(50):
        asks, free = rng.integers(0, 9, (6, 6)), rng.integers(0, 12, 6)
        allowed, room = sharding.quotas(asks, free)
        moved = allowed + room
        assert (moved.sum(0) == moved.sum(1)).all() and (allowed <= asks).all() and (room.sum(1) <= free).all()


# --- pipeline -----------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    d, sf = real(spark), SF
    for name, stage in P.STAGES[:-1]:
        nxt = common.stash(stage(spark, d, sf), name)
        assert sorted(nxt.columns) == sorted(d.columns)
        before, after = {r.doc_id: r.text for r in d.collect()}, {r.doc_id for r in nxt.collect()}
        if name == "simhash_near_dedup":
            ids = sorted(before)
            assert after == {ids[k] for k in slow_texts([before[i] for i in ids])}
        if name == "benchmark_decontamination":
            items = [decontam.shingles_of(decontam.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            leak = {i for i, t in before.items() for own in [decontam.shingles_of(decontam.words_of(t))] if any(s and len(s & own) >= 0.8 * len(s) for s in items)}
            assert after == set(before) - leak
        assert after <= set(before) and len(after) > 0.7 * len(before)
        d = nxt
    packed = P.STAGES[-1][1](spark, d, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in d.collect()}
    nulls = docs(spark, [None, "", "a"], [None, 1, 1]).select("doc_id", "text", "lang")
    assert corpus_rows(P.drop_near_duplicates(spark, nulls, sf)) == [1]
    nulls = docs(spark, ["x", "y", "x"], [None, None, 3]).selectExpr("doc_id", "text", "lang", "1 as _key")
    assert sorted(r.text for r in P.drop_near_duplicates(spark, nulls, sf).collect()) == ["x", "y"]


def corpus_rows(df):
    return [r.doc_id for r in df.where("doc_id is not null").collect()]
