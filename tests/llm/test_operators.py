"""The training-data operators against brute force, their libraries, or a round trip."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waymark.llm import exact_dedup, html_text, jaccard_join, maxent_lm, media, packing, sentencepiece_bpe, suffix_dedup, toxicity, warc
from waymark.llm.common import keyed_once, new_folder
from waymark.llm.queries import PIECES, WORDS

DATA = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "A b"), (4, "a B"), (4, "a B"), (None, "x"), (5, "word " * 4000), (6, "word " * 4000), (7, "Äİ 日本\x00�"), (None, None), (8, "one two three four"), (9, "One two three four")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names an operator might use."""
    return spark.createDataFrame([(i, t, 0, 0, "x") for i, t in ODD], "doc_id long, text string, row int, id int, body string")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("false")


def body(t):
    return (t or "").encode()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_exact_dedup(docs, odd, empty):
    for df, block in ((docs, 512), (odd, 3), (odd, 2048)):
        rows = [(r.doc_id, lower(r.text)) for r in df.collect()]
        groups = defaultdict(list)
        for i, t in rows:
            groups[t].append(i)
        got = exact_dedup.exact_dedup(df, block=block).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter((i, max((x for x in groups[t] if x is not None), default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
        assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.exact_dedup(empty).isEmpty()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" ▁  aeinrstthß日é\n\t<>0x1\x00\U0001d518е"), max_size=40))
def test_sentencepiece_encoding(text):
    model, library = sentencepiece_bpe.model(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = library.encode(text)
    assert model.encode(text) == ids and model.decode(ids + [2]) == library.decode(ids + [2])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 300), st.integers(0, 31999), st.sampled_from([28705, 2, 1])), max_size=8))
def test_sentencepiece_decoding(ids):
    assert sentencepiece_bpe.model(PIECES).decode(ids) == sentencepiece.SentencePieceProcessor(model_file=PIECES).decode(ids)


def test_sentencepiece_query(docs, odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for df in (docs, odd):
        ids = [library.encode(r.text or "") + [2] for r in df.collect()]
        got = sentencepiece_bpe.encode_decode(df, PIECES, with_ids=True).collect()
        assert [list(r.ids) for r in got] == ids
        assert [r.decoded_sha256 for r in got] == [hashlib.sha256(library.decode(x).encode()).hexdigest() for x in ids]
    assert sentencepiece_bpe.encode_decode(empty, PIECES).isEmpty()


def brute_suffix(texts, span):
    n = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if n[t[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest()))
    return out


def test_suffix_dedup(docs, odd, empty):
    for df, span in ((docs, 200), (odd, 200), (odd, 6), (docs.limit(40), 20)):
        df = df.checkpoint() if span == 20 else df
        texts = [body(r.text) for r in df.collect()]
        got = suffix_dedup.suffix_dedup(df, span=span).orderBy("row").collect()
        assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute_suffix(texts, span)
    assert suffix_dedup.suffix_dedup(empty).isEmpty()


def test_shuffles_of_suffix_dedup_go(spark, docs):
    """Each job's shuffle files go when it ends; else they add up on disk until the driver collects its garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    rows = keyed_once(docs, "doc_id", "text")
    before = files()
    found = suffix_dedup.repeats(rows)
    for _ in range(50):  # they go in the background
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and found.count() > 0


def test_suffixes_of_long_texts():
    rng = np.random.default_rng(3)
    text = bytes(rng.integers(97, 123, 5000, dtype="u1"))
    fp = suffix_dedup.Fingerprints(20000)
    starts = []
    for data, ends, which, first in suffix_dedup.parts([text, text[:90], text], 50, 700):
        _, _, lo, count = suffix_dedup.anchors(fp, data, ends, 50)
        at = np.searchsorted(ends, lo, side="right")
        begin = np.concatenate([[0], ends[:-1]])
        starts += [(int(which[t]), int(lo[k] - begin[t] + first[t]) + j) for k, t in enumerate(at) for j in range(count[k])]
    assert sorted(starts) == [(d, i) for d, n in ((0, 5000), (1, 90), (2, 5000)) for i in range(n - 49)]


def test_multikey_order():
    rng = np.random.default_rng(1)
    cols = [rng.integers(0, 3, 200).astype("u8") for _ in range(3)]
    order = suffix_dedup.multikey_order(cols)
    rows = list(zip(*(c.tolist() for c in cols)))
    assert [rows[k] for k in order] == sorted(rows)


@pytest.mark.parametrize("source,text", [
    ("<p>Hi <b>you</b><p>Two<br>lines", "Hi you\n\nTwo\nlines"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>", "- a\n- b\n\n  3. c\n  4. d"),
    ("<ol start=3><li>a<li value=7>b<li>c<li value=x>d</ol><ul><li value=4>e</ul>", "3. a\n7. b\n8. c\n9. d\n\n- e"),
    ("<table><tr><th>Name<th>Val<tr><td>long name<td>1</table>", "Name      | Val\nlong name | 1"),
    ("<title>x</title><script>if (a</b) </script>a<style>b</style> &amp; c<!-- d -->", "a & c"),
    ("<div style='color:red; display: none'>no</div><div hidden>no</div><p>yes", "yes"),
    ("<pre>  a\n   b</pre>", "  a\n   b"),
    ("", ""), ("a < b", "a < b"), ("<div>x</p>y</div></div>z", "x y\nz".replace("x y", "xy")),
])
def test_html(source, text):
    assert html_text.render(source) == text


def test_html_query(spark):
    deep = "<ul><li>" * 3000 + "x"
    df = spark.createDataFrame([(1, None), (2, ""), (None, "<p>a"), (4, deep)], "page_id long, html string")
    got = html_text.extract(df).collect()
    assert [r.text.strip("- ") for r in got] == ["", "", "a", "x"]
    assert html_text.extract(df.filter("false")).isEmpty()
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    for source, got in zip((r.html for r in pages.collect()), html_text.extract(pages).collect()):
        words = re.findall(r"\w+", re.sub(r"(?s)<(script|style|title|head)\b.*?</\1>|<!--.*?-->|<[^>]*>|&\w+;", " ", source))
        assert not words or got.text


def test_packing(docs, odd, empty):
    library = Tokenizer.from_file(WORDS)
    for df, capacity in ((docs, 4096), (odd, 16)):
        ids = [library.encode(r.text or "", add_special_tokens=False).ids + [2] for r in df.collect()]
        got = packing.pack(df, WORDS, capacity, with_ids=True).toPandas()
        assert got.length.sum() == sum(map(len, ids))
        for _, s in got.groupby("sequence_id"):
            s = s.sort_values("offset")
            assert (s.offset == s.length.cumsum() - s.length).all()
            total = int(s.length.sum())
            assert total <= capacity and total & (total - 1) == 0
        for r in got.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        if df is docs:
            whole = {i: np.concatenate(list(p.sort_values("start").ids)).tolist() for i, p in got.groupby("doc_id")}
            assert whole == {r.doc_id: x for r, x in zip(df.collect(), ids)}
    assert packing.pack(empty, WORDS).isEmpty()
    odd_texts = ["<|endoftext|> a'LL it's ½ ÀÉ \x1c x Σς 日本 é \xa0 naïve 12.5%", "İ ﬁ", "a\x1fb"]
    for t in odd_texts:
        assert np.frombuffer(packing.tokenizer(WORDS).ids(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_toxicity(spark, docs, odd, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(d, labels)
    got = toxicity.score(d, model).join(labels, "doc_id").filter("held_out").toPandas()
    p, n = got[got.toxic == 1].score, got[got.toxic == 0].score
    assert np.mean([(a > b) + 0.5 * (a == b) for a in p for b in n]) > 0.95
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()
    none = toxicity.fit(odd, labels.filter("false"))
    assert {r.predicted for r in toxicity.score(odd, none).collect()} == {0}
    assert toxicity.score(odd, model).count() == len(ODD) and toxicity.score(empty, model).isEmpty()
    other = toxicity.fit(d, labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert other.weights == model.weights


def test_nnpu_risk():
    rng = np.random.default_rng(0)
    y = rng.random(2000) < 0.3
    x = np.stack([np.where(y, rng.random(2000) < 0.9, rng.random(2000) < 0.05), rng.random(2000) < 0.5], 1)
    rows = [np.flatnonzero(r) for r in x]
    positive, all_ = toxicity.Rows([rows[k] for k in np.flatnonzero(y)[:300]], 2), toxicity.Rows(rows, 2)
    for batch in (512, 4096):
        w, b = toxicity.fit_nnpu(positive, all_, 0.3, np.zeros(2), 0.0, 300, batch=batch)
        assert w[0] + b > 0 > b
    v = rng.random(2)
    assert np.allclose(all_.dot(v), x @ v) and np.allclose(all_.back(np.arange(2000.0)), np.arange(2000.0) @ x)
    some = rng.permutation(2000)[:50]
    assert np.allclose(all_.some(some).dot(v), x[some] @ v)


def test_word_hashes():
    from waymark.llm import prints

    texts = [b"", b" a  B\tc ", b"xy z", b"   ", b"A b c", b"u" * (prints.PART + 9) + b" w5 " + b"v" * prints.PART + b" ", b" ".join(b"w%d" % k for k in range(90_000)), b"w5 w89999"]
    got = list(prints.WordHashes().of(texts))
    assert [len(h) for h in got] == [len(t.split()) for t in texts]
    assert got[1].tolist() == got[4].tolist() and got[5][1] == got[6][5] == got[7][0] and got[6][-1] == got[7][1]


def test_join_divides_regions_exactly(spark, monkeypatch):
    """Small cells and blocks, so that Voronoi regions are divided again; and texts of one template, none of them near."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 80)]
    rows = []
    for c in range(6):
        for _ in range(60):
            w = [f"c{c}_{k}" for k in range(60)] + base[: int(rng.integers(30, 80))]
            for at in rng.integers(0, len(w), rng.integers(0, 9)):
                w[at] = f"v{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(1000 + k, f"t{k} page you asked for is gone now") for k in range(300)]
    for name, n in (("_CELL", 8), ("_BLOCK", 8), ("_PIVOTS", 3), ("_MANY", 2)):
        monkeypatch.setattr(jaccard_join, name, n)
    got = jaccard_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("row").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == brute_groups(rows)


def test_pipeline_stages_take_odd_rows(spark):
    import corpus_pipeline as cp

    rows = [(1, "a b c " * 60, 5, "r"), (2, "A b c " * 60, 5, "r"), (None, None, None, None), (None, "", None, None), (3, "x " + "a long passage that repeats " * 9, 1, "q"), (4, "y " + "a long passage that repeats " * 9 + "z", 1, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_number int, kept_text string")
    left = {"toxicity": 6, "exact_dedup": 4, "jaccard_join": 5, "suffix_dedup": 6}
    for name, stage in cp.STAGES:
        got = stage(spark, df, DATA)
        if name in left:
            # the two long passages have 5 shingles of 8 in common, too few for near copies
            assert got.columns == df.columns and got.count() == left[name], name
        assert stage(spark, df.filter("false"), DATA).isEmpty(), name


def test_warc(spark, tmp_path):
    big = "x" * 1000
    rows = [(1, "http://a/", big), (2, "http://b c/", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (None, "u", "y" * 2000), (None, "u", "y" * 2000), (7, "u", big + "ø"), (2, "http://b c/", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    got = warc.round_trip(pages).collect()
    expect = [(i, len(body(h)), hashlib.sha1(body(h)).hexdigest(), "revisit" if (i, h) == (1, big) else "response", 2 if (i, h) == (1, big) else None) for i, _, h in rows]
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(expect)
    assert warc.round_trip(pages.filter("false")).isEmpty()


def test_warc_damage():
    import io

    one, two = warc.record("response", "urn:page:1", "u", b"abc" * 500), warc.record("response", "urn:page:2", "u", b"")
    assert [h["warc-record-id"] for h, _ in warc.read_records(io.BytesIO(one + two), 7)] == ["<urn:page:1>", "<urn:page:2>"]
    for bad in (one[:-9], one[:20] + b"\0\0\0" + one[23:], zlib.compress(b"x"), one + b"junk"):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad)))
    plain = zlib.decompress(one, 31)
    for bad in (plain.replace(b"abcabc", b"abcabd", 1), plain.replace(b"Content-Length: 15", b"Content-Length: 16", 1)):
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(pack.compress(bad) + pack.flush())))


def test_language_model(spark, odd, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, counts = maxent_lm.fit(d)
    got = {r.doc_id: r for r in maxent_lm.score(d, model, counts).collect()}
    rows = [(r.doc_id, body(r.text).lower().split() + [b""]) for r in d.collect()]
    train = [w for i, w in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(x for w in train for x in w)
    n, v = sum(c.values()), len(c)
    for i, w in rows:
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(x in c for x in w), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[x] + 1) / (n + v + 1)) for x in w))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    # a proper distribution: classes sum to one, tokens of a class to its share
    share = np.zeros(maxent_lm.CLASSES)
    for w, k in c.items():
        share[model.class_of(w)] += k + 1
    assert np.allclose(share, model.totals)
    # of every history the probabilities of all tokens and the unseen event sum to one
    vocabulary = list(c)
    for history in ([], [b"the"], [vocabulary[0], vocabulary[-1]], [b"never", b"seen"]):
        p = [10 ** brute_token(model, c, n, v, w, *history[::-1]) for w in vocabulary]
        assert sum(p) + 1 / (n + v + 1) == pytest.approx(1, abs=1e-4)
    for i, w in rows[::25]:
        assert got[i].score == pytest.approx(sum(brute_token(model, c, n, v, x, *w[max(0, k - 2) : k][::-1]) for k, x in enumerate(w)), rel=1e-4)
    assert maxent_lm.score(odd, model, counts).count() == len(ODD) and maxent_lm.score(empty, model, counts).isEmpty()
    m0, c0 = maxent_lm.fit(empty)
    assert maxent_lm.score(odd, m0, c0).filter("score is null or isnan(score)").isEmpty()


def brute_token(model, c, n, v, word, one=None, two=None):
    """log10 P(word | one before, two before), feature by feature in whole numbers."""
    if word not in c:
        return -np.log10(n + v + 1)
    side, first = maxent_lm.SIDE, maxent_lm._FIRST
    kind = model.class_of(word)
    h1, h2 = (0xFFFFFFFF if w is None else zlib.crc32(w) for w in (one, two))
    quarter, total = (len(model.weights) - first) // 4, 0.0
    for what, target in ((0, kind // side), (1 + kind // side, kind % side)):
        place = lambda x, size: ((((x + what * 0xC2B2AE3D27D4EB4F) * 0x9E3779B97F4A7C15) & (1 << 64) - 1) >> 36) % size  # noqa: E731, B023
        logits = model.weights[[what, first + place(h1, quarter), first + quarter + place(h2, quarter), first + 2 * quarter + place(h1 * 31 + h2 + 7, 2 * quarter)]].sum(0, dtype="f8")
        total += logits[target] - logits.max() - np.log(np.exp(logits - logits.max()).sum())
    return total / np.log(10) + np.log10((c[word] + 1) / model.totals[kind]) + np.log10((n + v) / (n + v + 1))


def brute_groups(rows, words=5):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", body(lower(t)))
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                old, new = root[a], root[b]
                root = [new if x == old else x for x in root]
    least = defaultdict(list)
    for (i, _), r in zip(rows, root):
        least[r] += [i] if i is not None else []
    return [(i, len(s), min(least[r], default=None)) for (i, _), s, r in zip(rows, sets, root)]


def test_jaccard_join(spark, docs, odd, empty):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 120)]
    near = []
    for k in range(700):
        w = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 12)):
            w[at] = f"v{rng.integers(0, 10**6)}"
        near.append((k, " ".join(w)))
    for df in (docs, odd, spark.createDataFrame(near, "doc_id long, text string")):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        got = jaccard_join.similar_groups(df).orderBy("row").collect()
        assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == brute_groups(rows)
    assert jaccard_join.similar_groups(empty).isEmpty()


def test_sketches_bound_distances():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype("u8") * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        cell = jaccard_join._Cell([len(a), len(b)], [0, 0], [jaccard_join.sketch(a), jaccard_join.sketch(b)], 1, 1000)
        i, _, gap = cell.pairs(np.array([0]), np.array([1]))
        assert not len(i) or (int(gap[0]) * (len(a) + len(b))) >> 20 <= len(np.setxor1d(a, b))


def test_media(spark, docs, odd, empty):
    for df in (docs, odd):
        rows = [(r.doc_id, body(r.text)) for r in df.collect()]
        got = media.media_columns(df).collect()
        expect = []
        for i, t in rows:
            p = media.padded(t)
            assert len(p) % 192 == 0 and p and media.from_png(media.to_png(p)) == p
            image = media.to_png(p)
            expect.append((i, len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(image), hashlib.sha256(image).hexdigest(), 192, len(p) // 192))
        assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256, r.width, r.height) for r in got) == Counter(expect)
    assert media.media_columns(empty).isEmpty()


def test_tar_shards_are_plain_tar(spark, docs):
    import tarfile

    folder = new_folder(spark, "t")
    _, index = media.store(docs, folder)
    r = index.first()
    assert media.metadata(index, folder).filter(F.col("digest") == r.digest).first().width == 192
    with tarfile.open(f"{folder.removeprefix('file://')}/{r.shard}") as t:
        m = t.getmember(f"{r.digest}.png")
        assert (m.offset_data, m.size) == (r.offset, r.length)
        assert hashlib.sha256(t.extractfile(m).read()).hexdigest() == r.digest


def test_pipeline(spark, docs):
    import corpus_pipeline as cp

    stage = dict(cp.STAGES)
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))).filter("predicted = 1").collect()}
    left = stage["toxicity"](spark, docs, DATA)
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - toxic and left.columns == docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    keep = {}
    for i, t in sorted(rows.items()):
        keep[lower(t)] = i
    assert {r.doc_id for r in stage["exact_dedup"](spark, docs, DATA).collect()} == set(keep.values())
    groups = brute_groups(list(rows.items()))
    assert {r.doc_id for r in stage["jaccard_join"](spark, docs, DATA).collect()} == {i for i, n, c in groups if i == c or not n}
    cut = {r.doc_id: r for r in stage["suffix_dedup"](spark, docs, DATA).collect()}
    for (i, t), (n, removed, _, sha) in zip(rows.items(), brute_suffix([body(t) for t in rows.values()], 200)):
        assert cut[i].n_chars == len(cut[i].text) and (removed or cut[i].text == t)
        assert len(cut[i].text.encode()) <= n - removed
    assert cp.run(spark, DATA).count() > 0


def test_near_copies_of_repeated_and_null_ids(spark):
    import corpus_pipeline as cp

    one, two, three, four = (" ".join(f"{c}{k}" for k in range(60)) for c in "abcd")
    rows = [(1, one), (1, two), (2, two + " x"), (None, three), (None, three + " x"), (None, four), (5, four + " x"), (7, ""), (7, None)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int")
    kept = {r.k for r in cp.drop_near_copies(spark, df, DATA).collect()}
    assert len(kept) == 6 and {0, 1, 6, 7, 8} < kept and kept & {3, 4}


def test_rows_keep_their_numbers_when_splits_change(spark, docs, monkeypatch):
    """Executors that come or go between two scans change how a file is split."""
    import corpus_pipeline as cp
    from waymark.llm import common

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sizes = iter(["7000", "20000000"] * 500)

    def after(f):
        def run(df, *args):
            out = f(df, *args)
            spark.conf.set("spark.sql.files.maxPartitionBytes", next(sizes))
            return out

        return run

    for module in (common, jaccard_join, suffix_dedup, exact_dedup, cp):
        for name in ("written", "pinned"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, after(getattr(module, name)))
    try:
        got = jaccard_join.similar_groups(docs).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(brute_groups(rows))
        got = suffix_dedup.suffix_dedup(docs).collect()
        assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(brute_suffix([body(t) for _, t in rows], 200))
        keep = {lower(t): i for i, t in sorted(rows)}
        assert {r.doc_id for r in cp.drop_copies(spark, docs, DATA).collect()} == set(keep.values())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("source,text", [
    ("<p>a<svg><title>t</title><defs><text>no</text></defs><rect/><g><text>b<tspan>c</tspan></text></g><desc/><text>d</text></svg>e", "a bc d e"),
    ("<p>x <math><mi>y</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math>", "x y=2"),
    ("<p>a<span aria-hidden=true>b</span>", "ab"),
    ("<input type=search value=a> <input type=email value=b> <input type=url value=c> <input type=password value=no> <input type=checkbox value=no>", "a b c"),
    ("<pre>a\n <img alt=b><svg><text>c</text></svg></pre>", "a\n b c"),
    ("<ul><li>" * 3000 + "x<img alt=y><table><tr><td>1<td>2</table><pre> p\n  q</pre>", "- " * 3000 + "xy\n\n" + "  " * 3000 + "1 | 2\n\n" + "  " * 3000 + " p\n" + "  " * 3000 + "  q"),
])
def test_html_of_drawings_forms_and_depth(spark, source, text):
    assert html_text.extract(spark.createDataFrame([(1, source)], "page_id long, html string")).first().text == text


def test_media_rows_name_their_images(odd):
    for r in media.media_columns(odd).collect():
        with open(r.shard.removeprefix("file://"), "rb") as f:
            f.seek(r.offset)
            image = f.read(r.length)
        assert hashlib.sha256(image).hexdigest() == r.digest == r.media_sha256 and media.png_header(image)[:2] == (r.width, r.height)


def test_words_that_polynomials_confuse_are_told_apart(spark):
    """A Thue-Morse word and its complement have equal polynomials modulo 2**64 whatever the base."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    fill = [f"w{k}" for k in range(4)]
    rows = [(1, word), (2, other), (3, " ".join([*fill, word, *fill, other])), (4, word.upper())]
    got = jaccard_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("row").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == brute_groups(rows) == [(1, 1, 1), (2, 1, 2), (3, 6, 3), (4, 1, 1)]


def test_features_of_very_long_words():
    from waymark.llm import prints

    long_word = b"Ab" * prints.PART
    seen = {}
    for k, body_ in enumerate((long_word, long_word.lower(), long_word + b" toxic", b"x" + long_word, b"toxic")):
        seen[k] = {int(f) for _, found in toxicity.Features()([body_]) for f in found}
    assert len(seen[0]) == 4 and seen[0] == seen[1] and seen[2] == seen[0] | seen[4] and not seen[3] & seen[0]
    short = {int(f) for _, found in toxicity.Features()([b"ababababab"]) for f in found}
    assert len(short & seen[0]) == 3  # their openings are the same


@pytest.mark.parametrize("source", ["<div>" * 8000 + "</q>" * 8000, "<ul><li>" * 8000 + "x", "<q><table><td>" + "<div>" * 8000 + "</q>" * 8000, "<p>" + "<b>" * 8000 + "<div>" * 8000, "<table><tr>" + "<td colspan=1000>a" * 300])
def test_html_takes_time_in_proportion(source):
    import time

    began = time.process_time()
    html_text.render(source)
    assert time.process_time() - began < 2


@pytest.mark.parametrize("source,text", [
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A | B\n  | C\nD | E"),
    ("<table><tr><td rowspan=2 colspan=2>A<td>B<tr><td>C</table>", "A |  | B\n  |  | C"),
    ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"), ("<ol reversed start=10><li>a<li value=4>b<li>c</ol>", "10. a\n4. b\n3. c"),
    ("<ol><li>a<p>b<ul><li>c<li>d</ul></ol>", "1. a\n\n   b\n\n   - c\n   - d"),
    ("<blockquote>a<ul><li>b<blockquote>c<p>d</blockquote></ul></blockquote>", "  a\n\n  - b\n\n      c\n\n      d"),
    ("<b>a<table><td></b>b</table>c", "a\n\nb\n\nc"), ("<table><tr><td>a</table></tr>b", "a\n\nb"),
])
def test_html_tables_and_lists(source, text):
    assert html_text.render(source) == text


class _Words:
    """Words that show, by the standard library's parser and a stack of hidden elements: no tree, no layout."""

    def __init__(self, source):
        from html.parser import HTMLParser

        self.words, self.hidden = [], []
        me = self

        class P(HTMLParser):
            def handle_starttag(self, tag, attrs):
                a = dict(attrs)
                gone = tag in html_text.HIDDEN or "hidden" in a or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style") or "")
                if tag in html_text.VOID:
                    if not me.hidden and not gone:
                        me.add(a.get("alt") if tag == "img" else a.get("value") if tag == "input" and (a.get("type") or "text").lower() not in html_text.NO_VALUE else "")
                elif me.hidden or gone:
                    me.hidden.append(tag)

            def handle_endtag(self, tag):
                if tag in me.hidden:
                    del me.hidden[len(me.hidden) - 1 - me.hidden[::-1].index(tag) :]

            def handle_data(self, data):
                if not me.hidden:
                    me.add(data)

        p = P(convert_charrefs=True)
        p.feed(source)
        p.close()

    def add(self, text):
        self.words += re.findall(r"\w+", text or "")


def test_html_words_of_all_given_pages():
    """Letters of all words that show, in order, against a reader without tree and layout; marks of lists aside."""
    import pyarrow.parquet as pq

    pages = [p for p in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist() if p]
    same = 0
    for source in pages:
        text = re.sub(r"(?m)^[ |]*(?:(?:- |\d+\. )+)", "", html_text.render(source))
        same += "".join(re.findall(r"\w+", text)) == "".join(_Words(source).words)
    assert same == len(pages) > 200
