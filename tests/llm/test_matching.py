"""Decontamination, license scan, SimHash and components against brute force."""

import random
import re

import pytest
import xxhash
from flowtide.llm import decontamination as D
from flowtide.llm import graph, licenses, queries, simhash
from flowtide.llm.oracle import ORACLE
from hypothesis import given, settings
from hypothesis import strategies as st


def nearest(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != t)))
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=1, max_size=12), st.text("ab", max_size=20))
def test_myers_is_the_edit_distance(pattern, text):
    assert D.myers(pattern, text, 99) == nearest(pattern, text)


def test_leaks_with_edits_are_found_and_clean_rows_left(spark, odd):
    item = "the quick brown fox jumps over the lazy dog while seventeen purple whales sing old songs about rivers and trees"
    bench = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (7, item)], "item_id bigint, text string")
    wrong = item.replace("purple", "purpel").upper()
    rows = [(100, f"before. {wrong}! after"), (101, f"only {' '.join(item.split()[:3])} here")]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = D.find_leaks(docs, bench).collect()
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in found] == [(100, 7, 2)]
    assert D.drop_leaks(docs, bench, block_bytes=1).count() == docs.count() - 1
    assert D.find_leaks(docs, bench.where("false")).count() == 0
    assert D.find_leaks(docs.where("false"), bench).count() == 0


def test_no_item_within_its_budget_is_missed(spark):
    draw = random.Random(1)
    words = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    item = " ".join(words[:16])
    segment = D.segments(1, item)[0]
    matcher = D.Matcher([(1, item)])
    for _ in range(100):
        text = list(item)
        for _ in range(segment.budget):
            text[draw.randrange(len(text))] = draw.choice("abcdefgh")
        text = f"xx {''.join(text)} yy".encode()
        near = nearest(segment.text, D.plain(text))
        assert near > segment.budget or matcher.hits(text) == {1: (near, 0)}


def made_items(count):
    draw = random.Random(4)
    return [(i, " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(9, 59)))) for i in range(count)]


def test_random_passages_of_items_are_found():
    draw, items = random.Random(5), made_items(40)
    matcher, shortest = D.Matcher(items), D.WINDOW_WORDS + D.STRIDE_WORDS - 1
    for item, text in items:
        words = text.split()
        for _ in range(5):
            size = draw.randint(shortest, len(words))
            at = draw.randint(0, len(words) - size)
            passage = f"zz yy {' '.join(words[at : at + size])} xx ww".encode()
            assert item in matcher.hits(passage) and matcher.clean([b"zz", passage]) == [True, False]


def test_items_with_a_tenth_of_their_bytes_changed_are_found():
    draw = random.Random(6)
    item = " ".join("".join(draw.choice("abcdefgh") for _ in range(9)) for _ in range(40))
    matcher = D.Matcher([(1, item)])
    for step in (12, 13, 14):
        text = [c if i % step or c == " " else "z" for i, c in enumerate(item)]
        assert 1 in matcher.hits(f"xx {''.join(text)} yy".encode())


def test_items_with_replaced_words_are_found():
    draw, items = random.Random(7), made_items(40)
    matcher = D.Matcher(items)
    for item, text in items:
        for step in (12, 16, 20) if text.count(" ") > 21 else ():  # else 9 words in a row may not stay
            words = [w if i % step else "z" * len(w) for i, w in enumerate(text.split(), draw.randrange(step))]
            assert item in matcher.hits(f"xx {' '.join(words)} yy".encode())


def test_licenses_match_sql(spark, con, sf_dir):
    mine = sorted(map(str, (tuple(r) for r in queries.op4_licenses(spark, sf_dir).collect())))
    assert mine == sorted(map(str, con.execute(ORACLE["op4_licenses"]).fetchall()))


@pytest.mark.parametrize(
    "text, label",
    [
        ("Licensed under the Apache License, Version 2.0 (the License)", "apache-2.0"),
        ("Released under the terms of the MIT License", "mit"),
        ("copyright (c) 2020 Some Person. All rights reserved", "copyright-notice,reserved"),
        ("copyright a b c d e f g h i all rights reserved", "reserved"),
        ("Released under the old MIT License", ""),
    ],
)
def test_templates(text, label):
    assert licenses.Scanner().scan(text.encode())[5] == label


def test_license_scan_of_odd_rows(odd, none):
    assert licenses.scan_licenses(odd).where("n_words = 0 and n_base = 0 and labels = ''").count() >= 2
    assert licenses.scan_licenses(none).count() == 0
    with pytest.raises(ValueError):
        licenses.compile_template("a <<optional>> b")


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", words) if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    root = list(range(len(rows)))
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if bin(a[1] ^ b[1]).count("1") <= 2 and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    ids = {r: min((d for (d, _), s in zip(rows, root) if s == r and d is not None), default=None) for r in root}
    return [ids[r] for r in root]


@pytest.mark.parametrize("max_list", [2000, 1])
def test_simhash_matches_brute_force(odd, docs, max_list):
    for table in (odd, docs.select("doc_id", "text")):
        rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in table.collect()]
        expected = sorted(
            ((d, f"{f:016x}", c) for (d, f), c in zip(rows, brute_components(rows))), key=str
        )
        assert sorted(map(tuple, simhash.near_duplicates(table, max_list).collect()), key=str) == expected


def test_links_over_close_fingerprints(spark):
    draw = random.Random(3)
    prints = {draw.getrandbits(64) for _ in range(20)}
    for _ in range(300):
        prints.add(draw.choice(sorted(prints)) ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64))
    prints = sorted(prints)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    expected = brute_components([(i, p) for i, p in enumerate(prints)])
    for max_list in (2000, 3):
        groups = simhash.fingerprint_groups(spark.createDataFrame(signed, "doc_id bigint, fp bigint"), max_list)
        assert [r[1] for r in sorted((r["first_key"], r["component_id"]) for r in groups.collect())] == expected


def test_lists_of_bytes_give_every_pair_once_at_every_depth(spark):
    draw = random.Random(8)
    prints = {draw.getrandbits(64) for _ in range(12)}
    for _ in range(150):
        prints.add(draw.choice(sorted(prints)) ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64))
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    pairs = sorted((a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    table = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    for max_list, depth in ((10**9, 1), (10**9, 4), (10**9, 6), (40, 1)):
        links = simhash.fingerprint_links(table, max_list, depth)
        assert sorted(map(tuple, links.collect())) == pairs


def test_depths_follow_the_number_of_fingerprints():
    assert [simhash.first_depth(n, 64) for n in (0, 64 * 256, 64 * 256 + 1, 10**7, 10**9, 10**30)] == [1, 1, 2, 3, 3, 6]
    assert [len(simhash.paths(d)) for d in range(1, 7)] == [3, 6, 10, 15, 21, 28]


def test_one_of_each_group_stays(odd, none):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "5", "None", "None"]
    assert simhash.keep_one(none).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.range(40).selectExpr("id as a", "id + 1 as b")
    assert {r["root"] for r in graph.components(links, "a", "b").collect()} == {0}
    assert graph.components(links.where("false"), "a", "b").count() == 0
