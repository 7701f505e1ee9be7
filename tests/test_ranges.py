"""Snapshots cut into ranges of any size, against the reader of whole ones."""

import numpy as np
import pytest

from waymark.sources import ranges, records

HEAD = '<?xml version="1.0"?><!-- <s id="no"> ]]> --><m a="x > y"><publicationTime>2015-01-01T00:00:00Z</publicationTime>'
GOOD = [
    HEAD + '<s id="1"/><s id="2"><s id="inner"><v>a</v></s>&amp;<![CDATA[</s><s>]]></s><!-- > --><t><s id=\'3\'>ø日<?pi <s> ?><!-- </s> --></s ></t></m>',
    "<m><x/>" + "".join(f'<s id="{k}"><v>{"y" * k}</v></s>\n' for k in range(5)) + "<publicationTime>2015-01-01T00:00:00Z</publicationTime></m>",
    '<s id="root"><publicationTime>2015</publicationTime></s>', HEAD + "</m>", HEAD + "text only, no record</m>",
    HEAD + '<sx id="1"/><n:s id="2"/><s n:id="3" id="4"></s></m>',
]
BAD = [HEAD + '<s id="1">', HEAD + '<s id="1"></t></s></m>', HEAD + "</s></m>", HEAD + '<s id="1"/></m', HEAD + '<s id="1"/></m></m>', "", HEAD + "<s/></m>", '<!DOCTYPE m><m/>', HEAD + "<!-- open </m>", HEAD + '<s id="1">&none;</s></m>', HEAD + '<s id="<"/></m>', "<m><publicationTime>when</publicationTime></m>", HEAD + "<s id='1'><!-- a </s></m>"]


def rows(df):
    got = df.collect()
    good = [(r.snapshot_name, r.ordinal, r.source_id, r.xml, str(r.publication_time), "") for r in got if r.error is None]
    return sorted([*good, *{(r.snapshot_name, -1, "", "", "", r.error.split(":")[0]) for r in got if r.error}])


def check(spark, tmp_path, texts, sizes, **more):
    data = []
    for k, t in enumerate(texts):
        body = t if isinstance(t, bytes) else t.encode()
        (tmp_path / f"{k:03}").write_bytes(body)
        data.append(("f", f"{k:03}", bytearray(body), "s", "s", f"{tmp_path}/{k:03}", len(body)))
    df = spark.createDataFrame(data, "feed string, snapshot_name string, content binary, record_element string, id_element string, path string, length long")
    expect = rows(records.explode_records(df.drop("path"), **more))
    for size in sizes:
        got = rows(ranges.explode_ranges(df.drop("content"), range_bytes=size, **more))
        assert got == expect, size
    return expect


def test_small_ranges_equal_the_whole(spark, tmp_path):
    assert len(check(spark, tmp_path, GOOD + BAD, (7, 40, 1 << 20))) > 20


def pieces(text, size):
    """Records and outside by ranges of a size, without Spark."""
    import pandas as pd

    path, n = text, range(0, max(1, ranges._File(text).size), size)
    frame = pd.DataFrame([(path, at, "s") for at in n], columns=["path", "at", "record_element"])
    effect = pd.concat(ranges._effects(size, False)(iter([frame])))
    starts = ranges._composed(effect)
    starts["record_element"] = starts["id_element"] = "s"
    out = pd.concat(ranges._parts(size, False)(iter([starts[["path", "at", "record_element", "id_element", "state", "depth"]]])))
    status = ranges._outsides(out[out.k.isna()])
    found = out[out.k.notna()].sort_values(["at", "k"])
    return list(zip(found.source_id, found.xml)), status.published.iloc[0], status.error.iloc[0]


@pytest.mark.parametrize("k", range(len(GOOD) + len(BAD)))
def test_cut_at_every_byte(tmp_path, monkeypatch, k):
    text = (GOOD + BAD)[k].encode()
    path = tmp_path / "x"
    path.write_bytes(text)
    published, expect, error = records.extract(text, "s", "s")
    for chunk in (3, 1 << 20):
        monkeypatch.setattr(ranges, "_CHUNK", chunk)
        for size in range(1, len(text) + 2 if chunk > 3 else 25):
            found, when, wrong = pieces(str(path), size)
            if error and error.startswith("malformed"):
                assert wrong, size
            elif error != "a record has no id":
                assert (wrong, (when or "").strip()) == (error, (published or "").strip()) and (error or found == expect), size


def test_random_documents(spark, tmp_path):
    rng = np.random.default_rng(2)
    bits = ["<s id='1'>", "</s>", "<s id='2'/>", "<!-- ", " -->", "<![CDATA[", "]]>", "text", "<v>", "</v>", "<?p ", "?>", "<s>", "&lt;", "é"]
    texts = [HEAD + "".join(rng.choice(bits, rng.integers(1, 8))) + "</m>" for _ in range(150)]
    texts += [HEAD + "".join(rng.choice(["<s id='1'><v>x</v></s>", "<s id='2'/>", "<!-- <s> -->", "<v/>", "<s id='3'><s id='4'/></s>"], rng.integers(1, 9))) + "</m>" for _ in range(60)]
    found = check(spark, tmp_path, texts, (11,))
    assert sum(not r[5] for r in found) > 60 and sum(bool(r[5]) for r in found) > 60


def test_encodings(spark, tmp_path):
    body = "<m><publicationTime>2015-01-01T00:00:00Z</publicationTime><s id='ø'>æ</s></m>"
    latin = ("<?xml version='1.0' encoding='iso-8859-1'?>" + body).encode("latin-1")
    assert check(spark, tmp_path, [latin, b"\xef\xbb\xbf" + body.encode(), body.encode("latin-1")], (9, 500))


def test_work_in_proportion_to_the_file(tmp_path, monkeypatch):
    """Short ranges neither read on far behind their ends, nor open the file or give an outside for each record."""
    body = "".join(f'<s id="{k}"><v>{k}</v></s>' for k in range(60_000)).encode()
    path = tmp_path / "x"
    path.write_bytes(HEAD.encode() + body + b"</m>")
    read, opened = [], []
    at = ranges._File.__init__

    class Counted:
        def __init__(self, f):
            self.f = f

        def size(self):
            return self.f.size()

        def read_at(self, n, offset):
            read.append(n)
            return self.f.read_at(n, offset)

    def counting(self, name):
        at(self, name)
        opened.append(name)
        self.f = Counted(self.f)

    monkeypatch.setattr(ranges._File, "__init__", counting)
    found, when, wrong = pieces(str(path), 1 << 14)
    assert (len(found), when, wrong) == (60_000, "2015-01-01T00:00:00Z", None)
    assert sum(read) < 5 * len(body) and len(opened) < 5


def test_records_in_no_root(tmp_path):
    """However many records on end are left out of what is parsed whole, two of them can't be a document."""
    for n in (2, 3, 40):
        (tmp_path / "x").write_bytes(b'<s id="1"/>' * n)
        for size in (5, 30, 1 << 20):
            assert pieces(str(tmp_path / "x"), size)[2].startswith("malformed")


def test_ranges_are_dealt_by_partitions_set(spark, tmp_path):
    """Rows of ranges are small, so that partitions sized by bytes would be one."""
    import os

    from pyspark.sql import functions as F

    (tmp_path / "x").write_bytes((HEAD + '<s id="1"/>' * 2000 + "</m>").encode())
    df = spark.createDataFrame([("f", "x", "s", "s", str(tmp_path / "x"), os.path.getsize(tmp_path / "x"))], "feed string, snapshot_name string, record_element string, id_element string, path string, length long")
    folders = []
    made, ranges.scratch = ranges.scratch, lambda s: folders.append(made(s)) or folders[-1]
    try:
        assert ranges.explode_ranges(df, range_bytes=500).count() == 2000
    finally:
        ranges.scratch = made
    written = spark.read.parquet(folders[1]).select(F.input_file_name().alias("file")).distinct().count()
    assert written == int(spark.conf.get("spark.sql.shuffle.partitions"))
