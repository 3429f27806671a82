"""Near-duplicates by shingle sets against all pairs."""

import random

import pytest
from flowtide.llm import minhash, oracle, queries

WORDS = " \t\n\x0b\x0c\r"


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in WORDS else c for c in lowered).split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Component of each row, by its place."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and 100 * both >= 85 * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(
        ((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str
    )


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def variants(draw, groups, each, length=(60, 200), most=6):
    texts = []
    for _ in range(groups):
        words = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(draw.randint(*length))]
        for _ in range(each):
            edited = list(words)
            for _ in range(draw.randrange(most)):
                edited[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
            texts.append(" ".join(edited))
    draw.shuffle(texts)
    return list(enumerate(texts))


def chain(draw, length, words=300, changed=3):
    """Each text differs from the one before in a few words, so that only neighbours are similar."""
    now, texts = [f"w{draw.randrange(10**6)}" for _ in range(words)], []
    for _ in range(length):
        now = list(now)
        for _ in range(changed):
            now[draw.randrange(words)] = f"x{draw.randrange(10**9)}"
        texts.append(" ".join(now))
    return texts


@pytest.mark.parametrize("short, block", [(2, 8), (32, 1024), (10**9, 1024)])
def test_components_equal_all_pairs_whatever_the_list_sizes(spark, short, block):
    draw = random.Random(3)
    rows = variants(draw, 3, 50)
    rows += [(1000 + i, t) for i, t in enumerate(reversed(chain(draw, 50) + chain(draw, 20)))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), short=short, block=block)
    assert result(found) == brute(rows)


def test_dissimilar_texts_with_a_long_common_passage(spark):
    draw = random.Random(4)
    head = " ".join(f"h{i}" for i in range(100))
    rows = [(i, head + " " + " ".join(f"t{draw.randrange(10**6)}" for _ in range(60))) for i in range(120)]
    rows.append((500, rows[7][1] + " end"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for short, block in ((4, 16), (32, 1024)):
        assert result(minhash.near_duplicates(df, short=short, block=block)) == brute(rows)


def test_ties_nulls_repeats_and_case(spark):
    same = "One two three four five six seven"
    rows = [
        (9, same), (3, same.upper()), (3, same.upper()), (None, same), (5, "one  two\tthree four five six seven"),
        (1, None), (2, ""), (4, " \n"), (6, "a b"), (7, "A  b"), (8, "b a"), (None, "alone"), (None, "only é"), (10, "only É"),
    ]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert result(found) == brute(rows)
    assert {r["doc_id"]: r["kept"] for r in found.collect() if r["doc_id"]} == {
        9: False, 3: True, 5: False, 1: True, 2: True, 4: True, 6: True, 7: False, 8: True, 10: True,
    }


def test_sample_documents(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert result(minhash.near_duplicates(docs)) == brute(rows)


def test_odd_and_empty_tables(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert result(minhash.near_duplicates(odd)) == brute(rows)
    assert minhash.near_duplicates(none).count() == 0


def test_recall_at_the_bound(spark):
    """Pairs of about 80 to 95 percent."""
    draw, rows, near = random.Random(6), [], 0
    for i in range(300):
        words = [f"p{draw.randrange(10**6)}" for _ in range(204)]
        other = words[: 204 - draw.randint(10, 24)]
        other += [f"q{draw.randrange(10**6)}" for _ in range(draw.randrange(17))]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        near += brute(rows[-2:])[1][2] == 2 * i
    assert 0 < near < 300
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found.where("not kept").count() == near


def test_sample_documents_against_sql(spark, con, sf_dir):
    mine = queries.QUERIES["op11_minhash"](spark, sf_dir)
    theirs = con.execute(oracle.ORACLE["op11_minhash"]).df()[mine.columns]
    assert sorted(map(str, mine.toPandas().values.tolist())) == sorted(map(str, theirs.values.tolist()))
