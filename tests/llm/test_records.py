"""Archives, URL filters, chat formatting and tokens."""

import uuid

import pytest
import sentencepiece
from flowtide.llm import chat, pieces, queries, sampling, url_filters, warc
from flowtide.llm.oracle import ORACLE
from flowtide.sources.settle import shared_folder
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ["op7_warc", "op8_url_filters", "op9_chat"])
def test_query_matches_sql(spark, con, sf_dir, name):
    theirs = con.execute(ORACLE[name])
    columns = [c[0] for c in theirs.description]
    mine = queries.QUERIES[name](spark, sf_dir).select(*columns).collect()
    assert sorted(map(str, map(tuple, mine))) == sorted(map(str, theirs.fetchall()))


def test_archives_of_odd_pages(spark):
    rows = [(3, "http://a/\r\nX: y", "same"), (1, None, "same"), (2, "u", None), (4, "u", ""), (None, "é", "same"), (1, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for table, count in ((pages, 6), (pages.where("false"), 0)):
        path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        warc.write_archives(table, path)
        found = warc.read_archives(spark, path).collect()
        assert len(found) == count and all(r["problem"] is None for r in found)
        if count:
            kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found)
            assert kinds == [
                ("1", "response", None, 4), ("1", "response", None, 4), ("2", "response", None, 0),
                ("3", "revisit", 1, 4), ("4", "revisit", 2, 0), ("None", "revisit", 1, 4),
            ]


def test_small_archives_hold_all_records(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").coalesce(1)
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    warc.write_archives(pages, path, archive_bytes=32 << 10)
    found = warc.read_archives(spark, path).collect()
    assert sorted(r["page_id"] for r in found) == sorted(r["page_id"] for r in pages.collect())
    assert all(r["problem"] is None for r in found)
    sizes = [r["length"] for r in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert len(sizes) > 3 and max(sizes) <= (32 << 10) + 8
    for records in ([b"x" * 900] * 5, []):
        parts = list(warc.archives(iter(records), archive_bytes=1))
        assert [len(p) for p in parts] == [2] * len(records)


def test_damage_is_reported():
    records = [warc.write_record(i, "http://a/", b"x" * i, None, False) for i in range(20)]
    (frames,) = warc.archives(iter(records))
    assert len(frames) == 21
    assert all(r["problem"] is None for r in warc.read_archive(b"".join(frames)))
    assert list(warc.read_archive(b"".join(frames)[:-3]))[-1]["problem"]
    cut = records[9].replace(b"Content-Length: 9", b"Content-Length: 8")
    assert warc.read_record(cut)["problem"]
    assert warc.read_record(b"")["problem"] == "no WARC header"


def test_hosts_are_shrunk_and_rules_win(spark):
    urls = [(i, f"http://Bad.Example.org/{i}") for i in range(40)] + [(100 + i, f"http://good.org/{i}") for i in range(40)]
    urls += [(200, None), (201, "no scheme"), (202, "http://sub.net/x"), (203, "http://bad.example.org/fr/a?b")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    marks = [(i, int(i >= 100), 0) for i, _ in urls if i < 200] + [(None, 1, 0), (0, None, None)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    found = {r["page_id"]: r for r in url_filters.judge_urls(pages, labels).collect()}
    assert found[0]["verdict"] == "block" and found[0]["host"] == "bad.example.org"
    assert found[100]["verdict"] == "allow" and found[203]["verdict"] == "allow" and found[202]["verdict"] == "block"
    assert found[200]["host"] == found[201]["path"] == ""
    assert url_filters.judge_urls(pages, labels.where("false")).where("verdict = 'allow'").count() == len(urls) - 1
    assert url_filters.judge_urls(pages.where("false"), labels).count() == 0


TEXTS = ["</s>[INST] ok [/INST]", "<\\/s>", "[\\\\INST]<s", "", None, "a\n</s>\\", "[/INST", "[INST]", "<", "x[/INST]<s>"]


def test_any_turn_reads_back(spark):
    roles = ["user", "assistant", None, "a\nb", "[INST]", "%25<s>"]
    rows = [(c, t, r, x) for c, r in enumerate(roles) for t, x in enumerate(TEXTS)] + [(None, None, "user", "x")] * 2
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = chat.format_conversations(turns).collect()
    assert len(found) == len(roles) + 1 and all(r["identical"] for r in found)
    for r in found:
        if r["conv_id"] is not None:
            assert [t["text"] for t in r["turns"]] == [x or "" for x in TEXTS]
            assert {t["role"] for t in r["turns"]} == {roles[r["conv_id"]] or ""}
    assert chat.digests(chat.format_conversations(turns.where("false"))).count() == 0


@pytest.fixture(scope="module")
def model():
    with open(pieces.MODEL_PATH, "rb") as file:
        return file.read()


def test_tokens_equal_the_reference(model, docs):
    codec = pieces.Codec(model, table_rows=50)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [r["text"] for r in docs.limit(60).collect()] + ["", " ", "  a  b ", "\x00é①😀", "a▁b", "x" * 5000]
    for text, (ids, same) in zip(texts, codec.encode(texts)):
        expected = theirs.encode(text)
        assert memoryview(ids).cast("i").tolist() == expected and same
        assert codec.decode(ids).decode() == theirs.decode(expected)


def test_whole_tokenizer_equals_the_reference(model):
    codec = pieces.Codec(model)
    codec.apart, codec.tokenizer = False, pieces.build_tokenizer(codec.model)
    assert all(same for _, same in codec.encode(["The text, whole.", "", " é ① "]))
    ids = codec.tokenizer.encode("a  é①", add_special_tokens=False).ids
    assert codec.tokenizer.decode(ids) == "a  é①"


def test_tokens_of_odd_rows(odd, none):
    found = pieces.encode_documents(odd).collect()
    assert len(found) == 8 and all(r["parity"] for r in found)
    assert [r["round_trip"] for r in found].count(False) == 1
    assert all(r["ids"] == [] for r in found if r["n_tokens"] == 0)
    assert pieces.encode_documents(none).count() == 0


def test_unigram_models_are_built():
    scored = [("<unk>", 0.0, pieces.UNKNOWN), ("▁", -3.0, 1), ("a", -2.0, 1), ("▁a", -1.0, 1)]
    model = pieces.Model(scored, pieces.UNIGRAM, False, True, False, b"")
    assert pieces.build_tokenizer(model).encode("a a").tokens == ["▁a", "▁a"]


def test_columns_of_clashing_names_do_no_harm(spark, sf_dir):
    """Tables with further columns, named like those that the operators add, give the same rows."""
    names = ("_id", "_label", "_order", "_row", "_key", "_first", "_payload", "good", "n", "mean", "domain", "suffix")
    names += ("host", "path", "rule", "upper", "prior", "source", "formatted", "rendered", "parsed", "key", "value")

    def wide(name):
        df = queries.table(spark, sf_dir, name)
        more = [F.lit("x").alias(n) for n in names if n not in df.columns]
        return df, df.select("*", *more)

    (pages, wide_pages), (labels, wide_labels), (turns, wide_turns) = map(wide, ("pages", "labels", "conversations"))
    for plain, extra in (
        (url_filters.judge_urls(pages, labels), url_filters.judge_urls(wide_pages, wide_labels)),
        (chat.digests(chat.format_conversations(turns)), chat.digests(chat.format_conversations(wide_turns))),
        (warc.with_first_page(pages), warc.with_first_page(wide_pages)),
        (sampling.known_labels(labels, "toxic", 50), sampling.known_labels(wide_labels, "toxic", 50)),
    ):
        assert plain.columns == extra.columns
        assert plain.exceptAll(extra).count() == 0 and plain.count() == extra.count()


def test_table_halves_give_what_one_table_gives():
    with open(pieces.MODEL_PATH, "rb") as file:
        model = file.read()
    texts = [" ".join(f"w{(i * j) % 97}{'é' * (j % 3)}" for j in range(60)) for i in range(40)] + [" two  blanks ", "▁ mark"]
    whole = pieces.Codec(model).encode(texts)
    small = pieces.Codec(model, table_rows=40)
    assert [small.encode([t])[0] for t in texts] == whole and len(small.table) <= 62
    assert all(same for _, same in whole[:-1])
