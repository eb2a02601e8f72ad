"""Small tables with nulls, ties, repeats and clashing columns; brute-force versions; queries against SQL."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import check
from talweg.llm import common, components, decontaminate, extract, jaccard, linededup, packing, quality, registry, sharding, tokens, topk, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n_lines int, score int, word string, digest int, row int, a int"


def docs_of(spark, texts, ids=None):
    rows = [(i, t, "en", 1, 2, "w", 3, 4, 5) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n != "pipeline"])
def test_query_equals_sql(spark, connection, name):
    note, good = check.compare(spark, connection, SF, registry.QUERIES[name], registry.ORACLES.get(name))
    assert good, note


# Sharding


def test_shards_move_only_under_changed_weights(spark):
    keys = spark.range(4000)
    leaves = sharding.tree(8)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 2.0 if x.shard == 5 else 1.0) for x in leaves]
    rows = sharding.place(sharding.place(keys, keys.id, leaves, "s"), keys.id, heavier, "t").collect()
    places = {x.shard: (x.region, x.rack) for x in leaves}
    moved = [(r.s, r.t) for r in rows if r.s != r.t]
    assert moved
    for s, t in moved:
        assert places[t][0] == 1  # into the region of the changed leaf, or inside it
        if places[s][0] == 1:
            assert places[t] == places[5]
        if places[s] == places[5]:
            assert t == 5
    counts = np.bincount([r.s for r in rows], minlength=8)
    assert counts.min() > 400


def test_shards_grow_into_the_new_one_only(spark):
    keys = spark.range(3000)
    for n in (8, 9, 12):
        df = sharding.place(keys, keys.id, sharding.tree(n), "s")
        rows = sharding.place(df, keys.id, sharding.tree(n + 1), "t").collect()
        assert {r.t for r in rows if r.s != r.t} == {n}
    with pytest.raises(ValueError):
        sharding.tree(7)


def test_shard_slots_are_gapless_with_nulls_and_repeats(spark):
    df = docs_of(spark, ["é", None, "", "a", "a"] * 30, [1, 2, None, 4, 4] * 30)
    rows = sharding.assign(df, cell_rows=2).collect()
    assert len(rows) == 150
    for s in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == {
        (1, 3, zlib.crc32("é".encode())), (2, 1, 0), (None, 1, 0), (4, 2, zlib.crc32(b"a"))
    }
    assert sharding.assign(empty(spark)).count() == 0


# Token counts


def test_transducer_equals_the_library(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = common.tokenizer_path("piece_bpe_32k.model")
    library, machine = sentencepiece.SentencePieceProcessor(model_file=path), tokens.transducer(path)
    rng = random.Random(3)
    texts = ["", " ", "<s> a</s> <0x0A>", " " * 90, "日本語文字列" * 50, "a▁b", "ab" * 3000, "ﬁ é \xa0 \U0001f600\n\tx"]
    texts += ["".join(rng.choice(" aeinthor\n▁1.,日é") for _ in range(rng.randrange(60))) for _ in range(800)]
    for text in texts:
        for size in (3, 7, 4096):
            assert machine.count(text, size) == len(library.encode(text)), (text, size)
    rows = tokens.count_tokens(docs_of(spark, [*texts[:6], None, texts[0]]), path, limit=10).collect()
    assert [r.n_tokens for r in rows] == [len(library.encode(t)) for t in texts[:6]] + [0, 0]
    assert [r.over_limit for r in rows] == [r.n_tokens > 10 for r in rows]
    assert rows[6].n_bytes == 0
    assert tokens.count_tokens(empty(spark), path).count() == 0


def test_chunk_maps_compose_in_any_order():
    machine = tokens.transducer(common.tokenizer_path("piece_bpe_32k.model"))
    text = tokens.MARK + "the quick brown fox jumps over the lazy dog".replace(" ", tokens.MARK) * 3
    maps = [machine.chunk_map(text[i : i + 5]) for i in range(0, len(text), 5)]
    left = maps[0]
    for m in maps[1:]:
        left = machine.compose(left, m)
    assert left == machine.scan(maps)


# Quality


def test_quality_learns_and_handles_odd_rows(spark):
    rng = random.Random(5)
    good = [". ".join(prose(rng, 8) for _ in range(6)) for _ in range(150)]
    bad = [" ".join(w.upper() + "!!###" for w in prose(rng, 50).split()) for _ in range(150)]
    df = docs_of(spark, [*good, *bad, None, "", "x" * 200_000])
    labels = spark.createDataFrame([(i, int(i < 150), "x") for i in range(300)] + [(0, 1, "x"), (None, 0, "x"), (5, None, "x")], "doc_id long, quality int, text string")
    described = common.stage(quality.describe(df))
    model = quality.fit(described, labels)
    held = {r.doc_id for r in described.filter(quality.held_out()).select("doc_id").collect()}
    assert held == {i for i in range(303) if zlib.crc32(str(i).encode()) % 5 == 0}
    scores = {r.doc_id: r.score for r in quality.score(described, model).collect()}
    assert len(scores) == 303 and all(0 <= s <= 1 for s in scores.values())
    assert np.mean([(scores[i] >= 0.3) == (i < 150) for i in held if i < 300]) > 0.95
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, s in scores.items() if s >= 0.3}
    none = quality.fit(described, labels.filter("doc_id < -1"))
    assert {r.score for r in quality.score(described, none).collect()} == {0.5}
    assert quality.score(quality.describe(empty(spark)), model).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = registry.QUERIES["op3_quality"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = scored.select("predicted", "quality").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_isotonic_levels_rise():
    at, level = quality._calibrated([(0.1, 2, 1), (0.2, 2, 0), (0.3, 1, 1), (0.4, 4, 1), (0.9, 3, 3)])
    assert (np.diff(level) > 0).all() and (np.diff(at) > 0).all()


# HTML


def test_extraction():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <nav><ul><li><a href=x>home</a></ul></nav><div class="cookie-notice">We use cookies, sorry</div>
    <main><article><h1>Head &amp;  line</h1><p>One, two&nbsp;three<br>four <b>five<p>Six <script>var x="</p>";</script>seven, <a href="y">link</a>.
    <ul><li>first<li>second</ul><aside>no</aside><form>q<input></form></article></main>
    <section id="comments"><p>nice, very, long, comment, with, commas</p></section><footer>&copy; us</footer></body></html>"""
    assert extract.extract(page) == "Head & line\nOne, two three four five\nSix seven, link.\nfirst\nsecond"
    for odd in (None, "", "<p>", "<!-- x", "<script>a", "</div></p>", "<nav>a</nav>"):
        assert extract.extract(odd) == ""
    assert extract.extract("plain < text &lt;b&gt;") == "plain < text <b>"
    assert extract.extract("<p>" + "long " * 50_000).count("long") == 50_000
    assert extract.extract("<div>" * 3000 + "deep, text" + "</div>" * 3000) == "deep, text"


def test_extraction_of_rows(spark):
    pages = spark.createDataFrame([(1, None, "u", 1), (1, "<p>é", None, 2), (None, "<p>é", None, 2)], "page_id long, html string, url string, text int")
    assert [tuple(r) for r in extract.extract_pages(pages).collect()] == [(1, "u", "", 0), (1, None, "é", 1), (None, None, "é", 1)]
    assert extract.extract_pages(pages.limit(0)).count() == 0


# Line dedup


def brute_lines(rows):
    order = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    seen, gone = set(), {}
    for i, t in order:
        lines = t.split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if w in seen:
                gone.setdefault((i, t), set()).update(range(k, k + 3))
            seen.add(w)
    return {(i, t): "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((i, t), ())) for i, t in order}


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(7)
    texts = ["\n".join(rng.choice("abcd") for _ in range(rng.randrange(12))) for _ in range(120)] + ["", "a\nb", "same\n" * 9]
    df = docs_of(spark, texts)
    want = brute_lines(list(enumerate(texts)))
    got = linededup.dedup_lines(df)
    assert got.columns == [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    for r in got.collect():
        assert r.text == want[r.doc_id, texts[r.doc_id]]
        assert r.n_lines == len(texts[r.doc_id].split("\n"))


def test_line_dedup_of_odd_rows(spark):
    df = docs_of(spark, [None, "a\nb\nc", "a\nb\nc", "x\na\nb\nc\ny", "a\nb\nc"], [0, 1, 1, 2, None])
    rows = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in linededup.dedup_lines(df).collect()), key=str)
    assert rows == [(0, None, 0, 0), (1, "", 3, 3), (1, "", 3, 3), (2, "x\ny", 5, 3), (None, "a\nb\nc", 3, 0)]
    assert linededup.dedup_lines(empty(spark)).count() == 0


# Jaccard join


def brute_components(texts, words, least):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    least_of = list(range(len(texts)))
    changed = True
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if sets[i] and 100 * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            m = min(least_of[i], least_of[j])
            changed |= least_of[i] != m or least_of[j] != m
            least_of[i] = least_of[j] = m
    return [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, least_of))]


def near_texts(rng):
    texts = [None, "", " \n", "one two", "One  two", "one", "a b c d", "a b c d"]
    for size in (6, 9, 15, 30, 80, 200, 700):
        base = prose(rng, size).split()
        for edits in (0, 1, 1, 2, 3, 5, 8, 12):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            texts.append(" ".join(copy))
            texts.append(" ".join(copy[: len(copy) - edits]).upper())
    chain = prose(rng, 60).split()
    for k in range(30):  # neighbours link, ends don't
        chain = [*chain[1:], f"c{k}"]
        texts.append(" ".join(chain))
    return texts


@pytest.mark.parametrize(("words", "least"), [(4, 85), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, words, least):
    texts = near_texts(random.Random(11))
    got = jaccard.link_components(docs_of(spark, texts), words, least).collect()
    assert sorted(map(tuple, got)) == brute_components(texts, words, least)


def test_pieces_keep_every_link():
    rng, bands = np.random.default_rng(2), jaccard.Bands(85)
    for size in (1, 2, 5, 7, 12, 40, 300, 3000):
        for _ in range(30):
            left = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            most = bands.difference(2 * len(left))
            keep = np.delete(left, rng.choice(len(left), min(most // 2, len(left) - 1), replace=False))
            right = np.unique(np.r_[keep, rng.integers(0, 2**64, most // 2, dtype=np.uint64)])
            common_ = len(np.intersect1d(left, right))
            if 100 * common_ >= 85 * (len(left) + len(right) - common_):
                assert np.intersect1d(jaccard.signatures(left, bands), jaccard.signatures(right, bands)).size
                words = min(len(jaccard._flat_sketch(left)), len(jaccard._flat_sketch(right)))
                a, b = (jaccard._folded(jaccard._flat_sketch(x), words) for x in (left, right))
                assert np.bitwise_count((a ^ b).view(np.uint64)).sum() <= len(left) + len(right) - 2 * common_


def test_buckets_across_batches():
    rng = random.Random(4)
    rows = sorted((rng.randrange(12), rng.randrange(6)) for _ in range(70))
    want = set()
    for key, group in itertools.groupby(rows, key=lambda r: r[0]):
        docs = sorted({d for _, d in group})
        if len(docs) > 1:
            want |= {(key, docs[0], d) for d in docs}
    for size in (1, 2, 3, 7, 70):
        batches = [
            pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[k : k + size]], pa.int64()) for i in (0, 1)], ["key", "doc"])
            for k in range(0, len(rows), size)
        ]
        got = [tuple(r.values()) for b in jaccard._buckets(iter(batches)) for r in b.to_pylist()]
        assert set(got) == want


def test_jaccard_of_odd_rows(spark):
    df = docs_of(spark, ["a b c d e", "a b c d e", "a b c d e", None], [3, 3, None, 7])
    assert sorted(map(str, map(tuple, jaccard.link_components(df).collect()))) == ["(3, 2, 3)", "(3, 2, 3)", "(7, 0, 7)", "(None, 2, None)"]
    assert jaccard.link_components(empty(spark)).count() == 0
    assert jaccard.keep_one_of_each(df).columns == df.columns


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 90), (7, 7)] + [(200, x) for x in range(201, 240)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[95] == got[90] == 90 and got[239] == 200


# Packing


def test_ids_equal_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    paths = packing._paths()
    library, encoder = tokenizers.Tokenizer.from_file(paths[0]), packing._encoder(*paths)
    rng = random.Random(8)
    texts = ["", "<|endoftext|> a <|endoftext|>", "I'll  can't\n\n  x\t1²½ é\xa0\xa0b", "日本 Ωμ", "a" * 3000]
    texts += ["".join(rng.choice(" aeIn'thlo\n1.,é²ª_\x1c\x85<|>") for _ in range(rng.randrange(80))) for _ in range(1500)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def brute_bins(sizes, capacity):
    """The least number of bins, by trying all ways."""
    best = len(sizes)

    def put(i, left):
        nonlocal best
        if len(left) >= best:
            return
        if i == len(sizes):
            best = len(left)
            return
        for b in {left[k]: k for k in range(len(left)) if left[k] >= sizes[i]}.values():
            put(i + 1, [*left[:b], left[b] - sizes[i], *left[b + 1 :]])
        put(i + 1, [*left, capacity - sizes[i]])

    put(0, [])
    return best


def test_bounds_and_best_fit():
    rng = random.Random(9)
    for _ in range(150):
        sizes = np.array(sorted((rng.randrange(1, 25) for _ in range(rng.randrange(1, 9))), reverse=True))
        least = brute_bins(sizes.tolist(), 24)
        bins, offsets, left = packing.best_fit(sizes, 24)
        assert packing.lower_bound(np.bincount(sizes, minlength=25)) <= least <= len(left) <= 11 * least / 9 + 1
        for b in range(len(left)):
            own = np.argsort(offsets[bins == b])
            assert (offsets[bins == b][own] == np.r_[0, np.cumsum(sizes[bins == b][own])[:-1]]).all()
            assert sizes[bins == b].sum() + left[b] == 24


def test_exchange_closes_gaps(spark):
    rng = random.Random(10)
    sizes = [rng.choice((100, 101, 350, 351, 500, 520, 660, 700, 1024)) for _ in range(600)]
    rows = spark.createDataFrame([(i % 9, s, "x") for i, s in enumerate(sizes)], "doc_id long, length long, bin string")
    got = packing.pack(rows, together=60).collect()
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == list(itertools.accumulate([0] + [s for _, s in own[:-1]])) and sum(s for _, s in own) <= 1024
    assert sorted(r.length for r in got) == sorted(sizes)
    alone = sum(len(packing.best_fit(np.array(sizes[k : k + 60]), 1024)[2]) for k in range(0, 600, 60))
    once = {r.sequence_id for r in packing.pack(rows, together=60, rounds=1).collect()}
    assert len(bins) <= len(once) <= alone
    assert packing.lower_bound(np.bincount(sizes, minlength=1025)) <= len(bins) <= alone


def test_packing_of_odd_rows(spark):
    df = docs_of(spark, [None, "", "a b", "a b", "word " * 3000], [1, 2, 3, 3, None])
    got = packing.pack_documents(df, *packing._paths()).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length) for r in got) == [
        ("1", 0, 0, 1), ("2", 0, 0, 1), ("3", 0, 0, 3), ("3", 0, 0, 3), ("None", 0, 0, 954), ("None", 1, 954, 1024), ("None", 2, 1978, 1024)
    ]
    assert len({r.sequence_id for r in got}) == 3
    assert packing.pack_documents(empty(spark), *packing._paths()).count() == 0


# Decontamination


def test_decontamination_of_odd_rows(spark):
    ten = "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10"
    bench = spark.createDataFrame(
        [(1, ten + " k11", "x"), (2, "Solo!", "x"), (3, None, "x"), (4, "--", "x"), (10, ten, "x")], "item_id long, text string, doc_id string"
    )
    texts = [None, "", f"a, {ten.upper()}. b", f"{ten} k11 {ten}", "k1 k2 k3 k4 k5 k6 k7 k8 k9 x k10", "x solo solo", f"a, {ten.upper()}. b", "éa"]
    ids = [0, 1, 2, 3, 4, 5, 2, None]
    df = docs_of(spark, texts, ids)
    rows = decontaminate.contamination(df, bench).select("doc_id", "n_words", "n_hit", "n_items").collect()
    want = [(0, 0, 0, 0), (1, 0, 0, 0), (2, 12, 10, 2), (3, 21, 21, 2), (4, 11, 0, 0), (5, 3, 2, 1), (2, 12, 10, 2), (None, 1, 0, 0)]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["0", "1", "4", "None"]
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    assert decontaminate.contamination(df, bench.limit(0)).filter("contaminated").count() == 0


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    df = docs_of(spark, ["blue x red y green", "red a b c d e green blue", "red red green", "green blue red"])
    phrases = decontaminate.phrases_of(bench)
    index = decontaminate.build_index(df, phrases)
    near = decontaminate.proximity_matches(index, phrases, slack=2).join(index.select("doc", "doc_id").distinct(), "doc")
    assert sorted(r.doc_id for r in near.collect()) == [0, 3]
    assert decontaminate.phrase_matches(index, phrases).count() == 0


# WARC


def test_archive_round_trip(spark):
    big = "<p>é" * 400
    rows = [(1, "u 1", big, 1), (2, None, big, 1), (3, "u", None, 1), (4, "u", "", 1), (5, "u", "short", 1), (6, "u", "short", 1), (None, "u", big, 1), (2, "u", big, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = sorted(((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.round_trip(pages).collect()), key=str)
    whole = big.encode()
    assert got == sorted(
        [
            ("1", len(whole), "revisit", 2, None), ("2", len(whole), "response", None, whole), ("2", len(whole), "response", None, whole),
            ("3", 0, "response", None, b""), ("4", 0, "response", None, b""), ("5", 5, "response", None, b"short"),
            ("6", 5, "response", None, b"short"), ("None", len(whole), "revisit", 2, None),
        ],
        key=str,
    )
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archive_layout():
    import io

    import zstandard

    records = [warc.record(i, f"http://x/{i}", b"<html>" + bytes([65 + i % 26]) * i, "d", None) for i in range(300)]
    content = warc.archive(records)
    magic, size = warc._FRAME.unpack(content[:8])
    assert magic == 0x184D2A5D
    words = zstandard.ZstdCompressionDict(content[8 : 8 + size])
    # Every record is a frame that can be read alone.
    rest = content[8 + size :]
    for want in records:
        frame = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
        assert frame.decompress(rest) == want
        rest = frame.unused_data
    assert not rest
    assert [block.partition(b"\r\n\r\n")[2] for _, block in warc.read_archive(io.BytesIO(content))] == [r.split(b"\r\n\r\n", 2)[2][:-4] for r in records]


# Top-k


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(300, 6)).round(1)
    rows = [(i, [float(x) for x in v], 1, 2) for i, v in enumerate(vectors)] + [(1000, None, 1, 2), (1020, [1.0, None] * 3, 1, 2), (1040, [float("nan")] * 6, 1, 2), (1060, [float("inf")] * 6, 1, 2), (None, [1.0] * 6, 1, 2), (2000, [1.0, 2.0], 1, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int, v int")
    whole = np.floor(64 * vectors.astype(np.float32).astype(np.float64))
    want = []
    for q in range(0, 300, 20):
        scores = whole @ whole[q]
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-scores[i], i))[:20]
        want += [(q, k + 1, i, int(scores[i])) for k, i in enumerate(best)]
    for shard, block in ((40, 4), (1000, 1000)):
        assert sorted(map(tuple, topk.top_k(df, shard=shard, block=block).collect())) == want
    assert topk.top_k(df.limit(0)).count() == 0
    few = df.filter("vec_id < 5 OR vec_id = 20")
    assert topk.top_k(few).count() == 2 * 5
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(100)], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in topk.top_k(same).filter("query_id = 0").orderBy("rank").collect()] == list(range(1, 21))
