"""Spelling variants, whitening and chat formatting against brute force, numpy and round trips."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waymark.llm import chat, spelling, whitening
from waymark.llm.queries import ORACLES, QUERIES, RANKS

DATA = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN


# Spelling variants


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_words(rows, least=6, count=5, slip=199):
    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(n, ratio=5):
    """All pairs of words that share a string with one letter less, each tested by its letters."""
    holes = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k] + w[k + 1 :]].add(w)
        holes[w].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def spelled(df, **more):
    return [tuple(r) for r in spelling.variants(df, **more).select("word", "form", "root", "n", "n_near", "form_n").collect()]


def key(rows):
    return sorted(rows, key=lambda r: r[0])


def test_spelling_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expect = brute_variants(brute_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert key(spelled(docs)) == key(expect) and sum(r[1] is not None for r in expect) > 100


@pytest.mark.parametrize("blocks", [False, True])
def test_spelling_of_few_letters(spark, monkeypatch, blocks):
    """Words over four letters: many are anagrams, chains of forms are long. Small subtrees are cut into blocks too."""
    rng = np.random.default_rng(4)
    rows = []
    for d in range(40):
        lengths = rng.integers(1, 9, 2000)
        rows.append((d, " ".join("".join(rng.choice(list("abcÿ"), k, p=[0.5, 0.3, 0.15, 0.05])) for k in lengths)))
    if blocks:
        monkeypatch.setattr(spelling, "_SUBTREE", 200)
        monkeypatch.setattr(spelling, "_LEAF", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelled(df, least_letters=1, least_count=2, ratio=2, slip=7)
    assert key(got) == key(brute_variants(brute_words(rows, 1, 2, 7), 2))
    assert any(r[2] not in (r[0], r[1]) for r in got)


def test_spelling_of_odd_rows(spark):
    long_run = "q" * 30_000
    rows = [(1, None), (2, ""), (None, "Kitten kittens kittén"), (3, "kitten " * 30 + "sitten " * 5 + "ÀÉcole× " * 6 + "àécole× " * 5), (3, "KITTEN"), (4, f"{long_run} {long_run}a " * 5), (5, "a1b2 -- 日本語 kitten\x00kitten")]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, n int, word int, id string")
    assert key(spelled(df)) == key(brute_variants(brute_words(rows)))
    assert spelled(df.filter("false")) == []
    nothing = spark.createDataFrame([(1, "no word is this long")], "doc_id long, text string")
    assert spelled(nothing) == []


# Whitening


def brute_whitening(vectors):
    """vec -> (deviation, whitened by component), n and explained, by numpy from all vectors at once."""
    x = [[int(np.floor(256 * float(c))) for c in v] for v in vectors]
    distinct = sorted(set(map(tuple, x)))
    n, s = len(distinct), [sum(c) for c in zip(*distinct)]
    a = np.array(distinct, float) - np.array(s) / n
    e, u = np.linalg.eigh(a.T @ a / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(4, int((e > 1e-12 * e[0]).sum()))
    moved = [[n * c - t for c, t in zip(v, s)] for v in x]
    white = np.array(moved, float) / n @ (u[:, :k] / np.sqrt(e[:k]))
    return n, [sum(c * c for c in m) for m in moved], white, e[:k] / e.sum()


def check_whitening(df, vectors):
    """vectors: id -> vector of each row that counts."""
    model = whitening.fit(df)
    got = whitening.whiten(df, model).toPandas()
    ids = list(vectors)
    n, deviation, white, explained = brute_whitening(list(vectors.values()))
    k = white.shape[1]
    assert len(got) == len(ids) * k and (got.n == n).all() and set(got.component) == set(range(1, k + 1))
    got = got.set_index(["vec_id", "component"])
    for c in range(k):
        own = got.xs(c + 1, level="component").loc[ids]
        assert own.deviation.tolist() == deviation
        sign = np.sign((own.whitened.to_numpy() * white[:, c]).sum())
        assert np.abs(own.whitened.to_numpy() - sign * white[:, c]).max() < 1e-8
        assert own.explained.to_numpy() == pytest.approx(explained[c], rel=1e-10)
    assert (got.identity_error < 1e-10).all()


def test_whitening_of_embeddings(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    check_whitening(df, {r.vec_id: r.embedding for r in df.collect()})


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(0)
    vectors = {k: (rng.standard_normal(6) * [9, 5, 3, 2, 1, 1]).tolist() for k in range(60)}
    vectors |= {k: [x / 512 for x in vectors[0]] for k in range(60, 64)}
    vectors |= {70: [float(v) + 1e-4 for v in np.floor(256 * np.array(vectors[1])) / 256], 71: [-0.0] * 6, 72: [0.0] * 6}
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (103, [float("nan")] * 6), (104, [float("inf")] + [0.0] * 5), (105, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 5, 6, "s") for i, v in [*vectors.items(), *odd]], "vec_id long, embedding array<double>, n int, x int, block string")
    check_whitening(df, vectors)
    assert whitening.whiten(df.unionByName(df), whitening.fit(df)).count() == 2 * 4 * len(vectors)
    empty = df.filter("false")
    assert whitening.whiten(empty, whitening.fit(df)).isEmpty() and whitening.whiten(df, whitening.fit(empty)).isEmpty()
    one = df.filter("vec_id in (71, 72)")
    assert whitening.fit(one).n == 1 and whitening.whiten(one, whitening.fit(one)).isEmpty()
    null_id = spark.createDataFrame([(None, vectors[1])], "vec_id long, embedding array<double>")
    assert {r.vec_id for r in whitening.whiten(null_id, whitening.fit(df)).collect()} == {None}


def test_whitening_of_low_rank_and_large_entries(spark):
    line = {k: [float(k), 2.0 * k, -1.0 * k] for k in range(20)}
    check_whitening(spark.createDataFrame(list(line.items()), "vec_id long, embedding array<double>"), line)
    huge = {k: [1e15 * k, 3.0 * k * k, 7.0] for k in range(9)}
    df = spark.createDataFrame(list(huge.items()), "vec_id long, embedding array<double>")
    got = whitening.whiten(df, whitening.fit(df)).filter("component = 1").orderBy("vec_id").collect()
    deviation = brute_whitening(list(huge.values()))[1]
    assert [r.deviation for r in got] == [d if d < 1 << 63 else None for d in deviation] and None in [r.deviation for r in got]
    beyond = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(beyond, whitening.fit(beyond)).count() > 0


@pytest.mark.parametrize("size,shape", [(1, "flat"), (5, "flat"), (90, "falling"), (200, "flat"), (200, "falling"), (40, "ties"), (30, "low")])
def test_eigenpairs(size, shape):
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    e = {"flat": 1 + rng.random(size), "falling": 1 / np.arange(1.0, size + 1), "ties": np.r_[[3.0] * 6, [1.0] * (size - 6)] if size > 6 else None, "low": np.r_[[2.0, 1.0], [0.0] * (size - 2)] if size > 2 else None}[shape]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.jacobi_davidson(lambda m: a @ m, size, 4)
    assert np.allclose(values, np.sort(e)[::-1][:4], rtol=0, atol=1e-13 * e.max())
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * e.max() and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-14)


def test_minres_solves():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    b = np.column_stack([rng.standard_normal((20, 2)), np.zeros(20)])
    assert np.allclose(a @ whitening.minres(lambda m: a @ m, b, 60, 1e-13), b, atol=1e-8)


# Chat formatting


TEXTS = st.lists(st.sampled_from([*"\\</turn>says #:\n é日", "<turn>", "</turn>", "<says>", "\\\\", "<\\turn>"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=5))
def test_marks_are_escaped_reversibly(turns):
    code = chat.coder(RANKS, PATTERN)
    text, spans = chat.render(turns, "user")
    assert list(chat.parse(text)) == turns
    ids = code.encode(text)
    assert code.bytes_of(ids).decode() == text
    assert sum(int(k) in code.marks.values() for k in ids) == 3 * len(turns)
    mask = chat.mask_of(code.sizes[ids], spans)
    assert chat.unescape(code.bytes_of(ids[mask]).decode()) == "".join(t for r, t in turns if r == "user")


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "x" + "\n\t" * 200_000 + "y", "é" * 100_000, "<" * 100_000, "</turn>" * 20_000])
def test_very_long_texts(text):
    code = chat.coder(RANKS, PATTERN)
    rendered, spans = chat.render([("user", "q"), ("assistant", text)], "assistant")
    ids = code.encode(rendered)
    assert chat.unescape(code.bytes_of(ids[chat.mask_of(code.sizes[ids], spans)]).decode()) == text


def test_ids_are_the_vocabulary_s_own():
    library, code = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), chat.coder(RANKS, PATTERN)
    library.encode_special_tokens = True
    for text in ("Hello, world's  end\n\n x", " é日本 <|endoftext|> 12", "tab\t\tand   spaces   "):
        ids = code.encode(chat.render([("user", text)], "user")[0]).tolist()
        assert ids[ids.index(code.marks[chat.SAYS]) + 1 : -1] == library.encode(text, add_special_tokens=False).ids
    assert tiktoken.__version__


def brute_chats(rows):
    of = defaultdict(list)
    for r in rows:
        of[r[0]].append(r)
    out = set()
    for c, own in of.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out.add((c, len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return out


def read(df, in_order=True):
    back = chat.read_back(chat.format_chats(df, RANKS, PATTERN), RANKS, PATTERN, in_order)
    return back.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    got = QUERIES["op13_chat_formatting"](spark, DATA).collect()
    assert {tuple(r)[:5] for r in got} == brute_chats([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{DATA}/conversations.parquet')")
    names = got[0].__fields__
    assert sorted(map(repr, con.sql(ORACLES["op13_chat_formatting"]).select(*names).fetchall())) == sorted(repr(tuple(r)) for r in got)
    own = next(r for r in got if r.conv_id == -7)
    assert own.formatted_chars == len(chat.render([("user", said), ("assistant", said)], "assistant")[0])


def test_chats_of_odd_rows(spark, monkeypatch):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, None, "no role"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (2, 0, "assistant", "A"), (None, 3, "user", "x"), (None, None, "assistant", "first"),
        (3, 5, "as\\sis<says>tant", "<turn>"), (3, -1, "assistant", "</turn><says>\\"), (4, 0, "assistant", "long " * 60_000), (5, 0, "assistant", "\x00\u2028 \ufffd"),
    ]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "conv_id long, turn long, role string, text string, piece int, ids string")
    for piece in (1 << 20, 3):
        monkeypatch.setattr(chat, "_PIECE", piece)
        got = read(df)
        assert len(got) == len({r[0] for r in rows}) and {tuple(r) for r in got} == brute_chats(rows)
    assert read(df.filter("false")) == []


def test_one_conversation_of_many_turns(spark, monkeypatch):
    """A conversation with most of the rows comes in pieces, whose ids are those of the whole; a written table reads the same."""
    rows = [(9, k, "assistant" if k % 2 else "user", f"turn {k} <turn> é") for k in range(3000)] + [(k, 0, "user", "hi") for k in range(10, 60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = chat.coder(RANKS, PATTERN).encode(chat.render([(r[2], r[3]) for r in rows[:3000]], "assistant")[0])
    monkeypatch.setattr(chat, "_PIECE", 5000)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/chats"
    chat.format_chats(df, RANKS, PATTERN).write.parquet(folder)
    formatted = spark.read.parquet(folder)
    pieces = formatted.filter("conv_id = 9 and piece >= 0").orderBy("piece").collect()
    assert len(pieces) > 5 and np.concatenate([p.ids for p in pieces]).tolist() == whole.tolist()
    back = chat.read_back(formatted.orderBy(F.rand(1)), RANKS, PATTERN)
    assert {tuple(r)[:5] for r in back.collect()} == brute_chats(rows)
