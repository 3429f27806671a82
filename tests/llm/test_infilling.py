"""Fill-in-the-middle against a plain version and round trips."""

import hashlib
import random
import re

import pytest
from flowtide.llm import infilling, oracle, queries

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(draw, number):
    pieces = ["word", "Zé", "été", "<", "P>", "<S", ">", " ", "\n", "漢字", "😀", "x", "1", "<P>"]
    for _ in range(number):
        yield "".join(draw.choice(pieces[: draw.randint(1, len(pieces))]) for _ in range(draw.choice([0, 1, 2, 9, 60, 400])))


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 4096])
def test_every_form_equals_the_plain_version(block):
    for doc_id, text in enumerate(texts(random.Random(block), 300)):
        made = infilling.transform(doc_id, text.encode(), block=block)
        expected = plain(doc_id, text)
        assert (*made[:4], made.output.decode()) == expected
        assert infilling.restore(made.output, made.form) == text.encode()


def test_fenwick_descent_and_sums():
    draw = random.Random(1)
    for size in (0, 1, 2, 3, 8, 13, 64):
        counts = [draw.choice([0, 0, 1, 5]) for _ in range(size)]
        tree = infilling.Fenwick(infilling.np.array(counts, infilling.np.int64))
        assert [tree.before(i) for i in range(size + 1)] == [sum(counts[:i]) for i in range(size + 1)]
        items = [(block, i) for block, count in enumerate(counts) for i in range(count)]
        assert [tree.find(k) for k in range(len(items))] == items
        assert tree.find(len(items))[0] == size


def test_sample_documents_and_sql(spark, docs, con, sf_dir):
    rows = {r["doc_id"]: r for r in infilling.infill(docs).collect()}
    for doc in docs.select("doc_id", "text").collect():
        n, form, prefix, middle, output = plain(doc["doc_id"], doc["text"] or "")
        got = rows[doc["doc_id"]]
        assert (got["n"], got["form"], got["prefix_chars"], got["middle_chars"]) == (n, form, prefix, middle)
        assert bytes(got["output"]).decode() == output and bytes(got["restored"]).decode() == (doc["text"] or "")
    mine = queries.QUERIES["op12_infilling"](spark, sf_dir)
    theirs = con.execute(oracle.ORACLE["op12_infilling"]).df()[mine.columns]
    plain_rows = lambda frame: sorted(map(str, frame.astype(object).where(frame.notna(), None).values.tolist()))
    whole = lambda frame: frame.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})
    assert plain_rows(whole(mine.toPandas())) == plain_rows(whole(theirs))


def test_odd_empty_and_very_long_texts(spark, odd, none):
    got = infilling.infill(odd).collect()
    assert len(got) == odd.count() and infilling.infill(none).count() == 0
    assert all(bytes(r["restored"]).decode() == t for r, t in zip(got, [d["text"] or "" for d in odd.collect()]))
    assert {r["form"] for r in got if r["n"] == 0} == {"plain"}
    long = "héllo, wörld " * 200_000
    made = infilling.transform(3, long.encode())
    assert (*made[:4], made.output.decode()) == plain(3, long)


def test_bytes_that_are_no_text():
    for i in range(50):
        text = random.Random(i).randbytes(200)
        made = infilling.transform(i, text, block=16)
        assert infilling.restore(made.output, made.form) == text
