"""Nulls, empty texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratamart.llm import common, extraction, forest, mixing, neighbours, packing, quality, records, repeats, simhash, tokens, url_filter
from stratamart.llm.components import components
from stratamart.llm.queries import byte_encoding, word_encoding
from tests.llm.test_queries import reachable, without

DOCS = "doc_id long, text string, source string, fingerprint string, size int, score int, offset int, row int"
LONG = "the quick brown fox jumps over the lazy dog and runs away from the very angry bear "


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (None, "a b c d e f"), (4, LONG * 300), (5, "x" + LONG * 2), (6, LONG + "é" * 90)]
    return spark.createDataFrame([(d, t, None if d == 2 else "s", "f", 1, 2, 3, 4) for d, t in texts], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_simhash(docs, empty):
    found = [tuple(r) for r in simhash.near_duplicates(docs, 4, 4).select("doc_id", "component_id").collect()]
    assert Counter(d for d, _ in found) == Counter([1, 1, 2, 3, None, 4, 5, 6])
    assert dict(found)[None] == 1 and dict(found)[3] == 2
    assert simhash.near_duplicates(empty, 4, 4).count() == 0


@pytest.mark.parametrize("distance", [3, 4])
def test_ball_links_lose_no_component(spark, distance):
    random = np.random.default_rng(distance)
    prints = random.integers(0, 2**63, 40, dtype=np.uint64)
    near = [p ^ np.bitwise_or.reduce(np.uint64(1) << random.choice(64, n, replace=False).astype(np.uint64)) for p in prints for n in (1, 3, 4, 5)]
    values = np.unique(np.concatenate((prints, near)))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash.ball_links(frame, distance, bucket_variants=5_000, at_once=3_000).collect()
    at = {int(v): i for i, v in enumerate(values.view(np.int64))}
    got = reachable(len(values), [(at[r["a"]], at[r["b"]]) for r in links])
    close = np.argwhere(np.bitwise_count(values[:, None] ^ values[None]) <= distance)
    assert got == reachable(len(values), close.tolist())
    assert all(int(values[at[r["a"]]] ^ values[at[r["b"]]]).bit_count() <= 2 * 64 for r in links)


def test_components(spark):
    random = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in random.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 260)]
    found = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    want = reachable(300, pairs)
    assert all(found.get(i, i) == want[i] for i in range(300))


def test_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (None, [0.0, 1.0]), (7, []), (20, [1.0, 0.0, 0.0]), (40, [1.0, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((tuple(r) for r in neighbours.near_duplicates(frame, 0.95).collect()), key=repr)
    want = [(0, 3, 0, True), (1, 3, 0, False), (1, 3, 0, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
            (None, 0, None, True), (7, 0, 7, True), (20, 0, 20, True), (40, 3, 0, False)]
    assert found == sorted(want, key=repr)
    assert neighbours.near_duplicates(frame.limit(0), 0.95).count() == 0
    got = [tuple(r) for r in forest.search(frame.where("vec_id = 0"), frame, 3).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 1, 1.0), (0, 3, 40, 1.0)]
    assert forest.search(frame.limit(0), frame, 3).count() == 0


@pytest.mark.parametrize("lengths", ["equal", "one outlier", "log-normal", "few long"])
@pytest.mark.parametrize("towards", [0.0, 3.0])
def test_forest_recall_whatever_the_lengths(lengths, towards):
    random = np.random.default_rng(11)
    n = 2000
    centres = random.standard_normal((40, 32))
    x = centres[random.integers(0, 40, n)] + 0.7 * random.standard_normal((n, 32)) + towards
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= {"equal": np.ones(n), "one outlier": np.where(np.arange(n) == 7, 20.0, 1.0), "log-normal": random.lognormal(0, 0.3, n),
          "few long": np.where(random.random(n) < 0.01, 30.0, 1.0)}[lengths][:, None]
    ids, asked = np.arange(n), np.arange(0, n, 20)
    right = 0
    for i, (found, scores) in zip(asked, forest.nearest(x, ids, x[asked], asked, 20)):
        want = x @ x[i]
        order = [j for j in np.lexsort((ids, -want)) if j != i][:20]
        assert len(found) == 20 and np.allclose(scores, want[found])
        right += len(set(found.tolist()) & set(order))
    assert right >= 0.9 * 20 * len(asked)


def test_large_buckets_are_cut_and_lose_nothing(spark):
    random = np.random.default_rng(5)
    x = np.array([1.0] + [0.0] * 15) + 0.02 * random.standard_normal((60, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "_vec long, embedding array<double>")
    classes = neighbours.classes_of(frame)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    pairs = neighbours.links(classes, 0.95, block=8).count()
    assert pairs == int(np.triu(unit @ unit.T >= 0.95, 1).sum())


def test_records(docs, empty, tmp_path):
    index = records.write(docs, byte_encoding(), f"file://{tmp_path}")
    found = records.read(index).collect()
    assert Counter(r["doc_id"] for r in found) == Counter([1, 1, 2, 3, None, 4, 5, 6])
    assert {r["doc_id"]: r["n_tokens"] for r in found}[2] == 1
    spans = sorted((r["start"], r["start"] + r["n_tokens"]) for r in found)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert records.read(records.write(empty, byte_encoding())).count() == 0
    with pytest.raises(ValueError):
        records.unframe(records.frame(b"abcdef")[:-1] + b"?")
    assert records.crc32c(b"123456789") == 0xE3069283 and records.unframe(records.frame(b"")) == b""


def test_many_records_at_once():
    random = np.random.default_rng(7)
    sizes = np.array([0, 1, 2, 3, 4, 5, 255, 256, 257, 0, 511, 512, 513, 70_000])
    data = random.integers(0, 256, sizes.sum(), dtype=np.uint8)
    payloads = [part.tobytes() for part in np.split(data, np.cumsum(sizes)[:-1])]
    table = [0] * 256
    for i in range(256):
        c = i
        for _ in range(8):
            c = c >> 1 ^ (records.POLYNOMIAL if c & 1 else 0)
        table[i] = c

    def plain(text):
        crc = 0xFFFFFFFF
        for byte in text:
            crc = crc >> 8 ^ table[(crc ^ byte) & 255]
        return crc ^ 0xFFFFFFFF

    assert records.checksums(data, sizes).tolist() == [plain(p) for p in payloads]
    written = records.frames(data, sizes)
    assert written == b"".join(map(records.frame, payloads))
    whole, inner = records.unframes(written, sizes + 16)
    assert whole == data.tobytes() and inner.tolist() == sizes.tolist()
    ends = np.cumsum(sizes + 16)
    for at in (0, 9, ends[4], ends[4] + 9, ends[4] + 13, len(written) - 1):
        broken = bytearray(written)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframes(bytes(broken), sizes + 16)
    with pytest.raises(ValueError):
        records.unframes(written[:-1], sizes + 16)


def test_records_are_read_in_any_order_and_number(docs, tmp_path):
    index = records.write(docs, byte_encoding(), f"file://{tmp_path}")
    want = {(r["file"], r["offset"]): r["ids"] for r in records.read(index).collect()}
    some = index.where("doc_id is null or doc_id <> 3").orderBy("bytes", "offset")
    twice = some.unionByName(some).coalesce(1)
    found = [((r["file"], r["offset"]), r["ids"]) for r in records.read(twice).collect()]
    assert len(found) == 14 and all(want[at] == ids for at, ids in found)


ODD_TEXTS = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "\n", "a\nb c", "a \nb", "a\n b", "a\n\nb\n", "tab\tx y", "one\u00a0two three", "\u3000x \u3000y z",
    "don't we'll I'M it's 's 's 't", "12 345 6,789.0", "\u0120 \u0120a b\u0120c \u0120", "caf\u00e9 cafe\u0301 \u00c9T\u00c9 \u03a3\u03a3 \u0301x", "\U0001f600 a\U0001f600b \u4f60\u597d \u4e16\u754c",
    "x<|endoftext|>y z", "<|startoftext|> a <|endoftext|>", "\x00 a\x00b \x1c c\x1d d", "a\r\nb c\x85d e", "\u200b a\u200b b",
]


@pytest.mark.parametrize("encoding", [byte_encoding(), word_encoding()], ids=["bytes", "words"])
def test_ids_are_the_tokenizers_own(encoding, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 50)
    monkeypatch.setattr(tokens, "TOGETHER", 7)
    encode = tokens._Encoder(encoding.path, encoding.before_word, encoding.spaced)
    random, parts = np.random.default_rng(3), [t for t in ODD_TEXTS if t]
    mixed = [" ".join(parts[i] for i in random.integers(0, len(parts), 9)) for _ in range(40)]
    long = [" ".join(f"w{i * j}," for j in range(90)) for i in range(1, 4)]
    for texts in (ODD_TEXTS, mixed, long, ODD_TEXTS[::-1], mixed):
        want = [np.array(encode.tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        for kind in (pa.string(), pa.large_string()):
            assert encode(pa.array(["before", *texts], kind).slice(1)) == want


def test_words_whose_ids_hold_the_space_are_encoded_without_offsets():
    encoding = byte_encoding()
    encode = tokens._Encoder(encoding.path, encoding.before_word, encoding.spaced)
    real = encode.tokenizer

    class WithoutOffsets:
        encode_batch_fast = real.encode_batch_fast

    encode.tokenizer = WithoutOffsets()
    text = " ".join(f"word{i} it's, {LONG}\u0120{i}" for i in range(300))
    assert np.frombuffer(encode(pa.array([text]))[0], dtype="<u4").tolist() == real.encode(text, add_special_tokens=False).ids


def test_packing(docs, empty):
    packed = packing.pack(packing.pieces(docs, word_encoding(), 64), 64)
    whole = packing.sequences(packed).collect()
    assert all(len(r["ids"]) <= 256 for r in whole) and packing.pack(packing.pieces(empty, word_encoding())).count() == 0


def test_plan_is_gapless():
    random = np.random.default_rng(1)
    counts = Counter(np.minimum(100, random.geometric(0.03, 5000)).tolist())
    filled = {}
    for length, _, count, sequence, offset in packing.plan(counts, 100):
        for i in range(count):
            filled.setdefault(sequence + i, []).append((offset, length))
    assert Counter(n for parts in filled.values() for _, n in parts) == counts
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    assert len(filled) <= -(-sum(n * c for n, c in counts.items()) // 100) + 3


def test_quality(spark, docs, empty):
    labelled = docs.selectExpr("doc_id", "text", "1 as label")
    assert {r["score"] for r in quality.score(docs, quality.fit(labelled)).collect()} == {0.5}
    assert quality.score(empty, quality.fit(labelled)).count() == 0
    both = spark.createDataFrame([(i, "good words here" if i % 2 else "BAD!! $$$ junk", i % 2) for i in range(40)], "doc_id long, text string, label int")
    scored = quality.score(both, quality.fit(both))
    assert all(r["predicted"] == r["label"] for r in scored.collect())


def test_quality_of_a_text_without_evidence_is_that_of_the_labels(spark):
    rows = [(i, LONG * (5 + i % 40) if i % 4 else "BAD!! $$$ junk " * (30 + i % 40), min(i % 4, 1)) for i in range(200)]
    model = quality.fit(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert model.score("") == model.score(None) == pytest.approx(0.75)
    assert model.score("the bear runs") >= 0.5 > model.score("BAD!! $$$ junk " * 30)


def test_url_filter(spark):
    entries = spark.sql("""SELECT * FROM VALUES ('domain', 'Example.com', 'block', timestamp'2024-01-01'),
        ('domain', 'example.com', 'clear', timestamp'2024-02-01'), ('domain', 'example.com', 'allow', timestamp'2024-02-01'),
        ('host', 'a.example.com', 'allow', timestamp'2024-01-10'), ('prefix', 'a.example.com/x/', 'block', timestamp'2024-01-20'),
        (null, 'example.com', 'block', timestamp'2020-01-01'), ('host', null, 'block', null) AS t(kind, pattern, verdict, since)""")
    captures = spark.sql("""SELECT *, 1 AS verdict FROM VALUES (1, 'http://b.example.com/', timestamp'2023-01-01'), (2, 'http://B.example.com:80/', timestamp'2024-01-01'),
        (3, 'https://a.example.com/x/y?z', timestamp'2024-01-15'), (4, 'https://a.example.com/x/y?z', timestamp'2024-01-25'),
        (5, 'https://a.example.com/xy', timestamp'2024-01-25'), (6, 'http://b.example.com', timestamp'2024-03-01'), (7, null, timestamp'2024-03-01'),
        (8, 'http://b.example.com', null), (8, 'http://b.example.com', null) AS t(id, url, fetched_at)""")
    found = sorted((r["id"], r["verdict"], r["kept"]) for r in url_filter.filter_urls(captures, entries).na.fill("-", ["verdict"]).collect())
    assert found == [(1, "-", True), (2, "block", False), (3, "allow", True), (4, "block", False), (5, "allow", True), (6, "allow", True),
                     (7, "-", True), (8, "-", True), (8, "-", True)]
    assert url_filter.filter_urls(captures.limit(0), entries).count() == 0
    assert url_filter.filter_urls(captures, entries.limit(0)).where("kept").count() == 9


def test_mixing(docs, empty):
    found = mixing.mix(docs, mixing.words("text")).collect()
    assert len(found) == 8 and all(r["taken"] <= 3 * r["size"] for r in found)
    assert {r["target"] for r in found if r["source"] is None} == {0.0}
    assert mixing.mix(empty, mixing.words("text")).count() == 0


@pytest.mark.parametrize("chunk", [200, 1 << 21])
def test_repeats(spark, docs, empty, chunk):
    random = np.random.default_rng(chunk)
    parts = ["".join(random.choice(list("abé "), 60)) for _ in range(6)] + ["a" * 70, "ab" * 40, "", "z" * 49]
    rows = [(int(d), "".join(random.choice(parts, 3))) for d in random.integers(0, 25, 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.removed_spans(frame, chunk_bytes=chunk, bucket_phrases=50).collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in found]
    assert sorted(got) == sorted(without(rows))
    cut = repeats.without_passages(docs)
    assert set(cut.columns) == set(docs.columns) and cut.count() == 8
    assert repeats.removed_spans(empty).count() == 0


def test_passages_leave_whole_characters(spark):
    """The text is decoded in the Python step that cuts it, so a task keeps one worker; half a character goes."""
    cut = repeats.without_passages(spark.createDataFrame(
        [(1, "x" + "a" * 49 + "é", "p"), (2, "a" * 49 + "ê" + "b", "q"), (None, None, None)], "doc_id long, text string, `Kept.x` string"))
    assert cut.columns == ["doc_id", "Kept.x", "text"]
    assert {tuple(r) for r in cut.collect()} == {(1, "p", "x" + "a" * 49 + "é"), (2, "q", "b"), (None, None, "")}
    assert str(cut._jdf.queryExecution().optimizedPlan()).count("MapInArrow") == 1


def test_wide_texts_come_in_small_batches(spark, monkeypatch, tmp_path):
    """Texts go to the encoder in Arrow batches bounded by bytes, whatever the setting outside, which is left as it was."""
    def sizes(batches, encoding, unit=1):
        for batch in batches:
            yield batch.column(0).to_pylist(), [np.array([batch.column("text").nbytes // unit], dtype="<u4").tobytes()] * batch.num_rows

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    wide = spark.range(0, 300, 1, 1).selectExpr("id AS doc_id", "repeat(CAST(id AS STRING), 30000) AS text")
    def kilobytes(batches, encoding):
        return sizes(batches, encoding, 1000)

    monkeypatch.setattr(packing, "encoded", sizes)
    monkeypatch.setattr(records, "encoded", kilobytes)
    spark.conf.set(name, "1g")
    try:
        batches = [int.from_bytes(r["ids"], "little") for r in packing.pieces(wide, word_encoding()).collect()]
        ids = [int.from_bytes(r["ids"], "little") for r in records.read(records.write(wide, byte_encoding(), str(tmp_path))).collect()]
        assert spark.conf.get(name) == "1g"
    finally:
        spark.conf.unset(name)
    assert len(batches) == len(ids) == 300
    assert max(batches) <= common.BATCH_BYTES + 100_000 and 1000 * max(ids) <= common.BATCH_BYTES + 100_000


def test_extraction(spark):
    page = """<html><head><title>t</title><style>x</style></head><body><nav><a href=a>menu</a></nav><div class="ad">buy</div>
      <div id=main><h1>Head &amp; line</h1><p>First  <b>bold</b>er&nbsp;text that goes on for a while, as articles do, and on.<p>Second <a href=x>link</a>
      paragraph, open at its end, with several words more</div><div class="comments"><p>me too, a reader says at length here</p></div><footer>f</footer></body>"""
    rows = [(1, page, "x"), (2, None, "x"), (3, "", "x"), (4, "plain < text", "x"), (5, "<div><p>" * 3000 + "deep", "x"), (6, "<script>only", "x")]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = {r["page_id"]: r["text"] for r in extraction.extract(frame).collect()}
    assert found[1] == ("Head & line First bolder text that goes on for a while, as articles do, and on. Second link paragraph, open at its end, "
                        "with several words more")
    assert found[2] == found[3] == found[6] == "" and found[4] == "plain < text" and found[5] == "deep"
    assert extraction.extract(frame.limit(0)).count() == 0


STORY = " ".join("Word after word the story goes on, and nothing in it is a link at all." for _ in range(6))


@pytest.mark.parametrize("wrapper", ['<div class="layout with-sidebar">', '<div id="page-header-content">', '<div class="no-comments">',
                                     '<div class="social">', '<div class="wide related">', '<div class="share">', '<form id="aspnetForm">'])
@pytest.mark.parametrize("inside", ["<h1>Head</h1><p>{0}</p><p>{0}</p>", "<p>{0}</p><p>{0}</p>", "<article><h1>Head</h1><p>{0}</p><p>{0}</p></article>"])
def test_extraction_keeps_articles_in_wrappers_with_names_of_furniture(wrapper, inside):
    end = "</form>" if wrapper.startswith("<form") else "</div>"
    page = f"""<body><nav><a href=x>go</a></nav>{wrapper}{inside.format(STORY)}{end}<div class="ad">buy this</div>
      <div class="social-share">tell all</div><form><label>Name</label><input name=a></form></body>"""
    assert extraction.main_text(page) == " ".join((["Head"] if "Head" in inside else []) + [STORY] * 2)


@pytest.mark.parametrize("page, want", [
    ("<body><article><h1>Head</h1><p>{0}</p><p>{0}</p><p>{0}</p></article><article><p>{0}</p><p>Second</p></article></body>", "Head {0} {0} {0} {0} Second"),
    ("<body><main><article><p>{0}</p><p>{0}</p><p>{0}</p></article><h2>Between</h2><section><article><p>{0}</p><p>{0}</p></article></section></main></body>",
     "{0} {0} {0} Between {0} {0}"),
    ("<body><div><p>{0}</p><p><a href=x>A paragraph that is a link as a whole</a></p><ul><li><a href=y>Source</a></li></ul><p>{0}</p></div></body>",
     "{0} A paragraph that is a link as a whole Source {0}"),
    ("<body><div>bo<b>ld</b>er <i>{0}</i> and on</div></body>", "bolder {0} and on"),
    ("<body><p>one <b>{0} <i>{0}</i></b> two</p></body>", "one {0} {0} two"),
])
def test_extraction_drops_nothing_of_split_link_rich_and_unmarked_articles(page, want):
    assert extraction.main_text(page.format(STORY)) == want.format(STORY)


@pytest.mark.parametrize("at_once", [1, 7, 100, 1 << 19])
def test_strings_are_sorted_alike_in_runs_of_any_size(at_once):
    match, width = 10, 5
    random = np.random.default_rng(1)
    data = random.integers(97, 100, 4000).astype(np.uint8)
    data[2000:2600] = data[100:700]
    raw, of = data.tobytes(), {}
    parsed = repeats.parse(data, np.array([0, 900, 2100, 3000]), match, width)
    for first, count, trigger, piece in zip(parsed.first, parsed.count, parsed.trigger, parsed.piece):
        phrase = bytes((trigger - first,)) + raw[first:first + count + match - 1]
        of[phrase] = min(of.get(phrase, 9), int(piece))
    phrases, names, want = list(of), {}, {}
    triggers = np.array([names.setdefault(p[1 + p[0]:1 + p[0] + width], len(names)) for p in phrases])

    def strings(phrase):
        return [phrase[i:i + match] for i in range(1, len(phrase) - match + 1)]

    for phrase, doc in of.items():
        for s in strings(phrase):
            want[s] = min(want.get(s, 9), doc)
    found = repeats.smallest_documents(phrases, np.array(list(of.values())), triggers, match, at_once)
    assert [x.tolist() for x in found] == [[want[s] for s in strings(p)] for p in phrases]
