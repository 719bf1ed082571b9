"""Queries with an SQL twin next to DuckDB, and the edge cases of the native operators."""
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from tabulon.llm import chat, decontam, linededup
from tabulon.llm.catalog import QUERIES, SQL

DOCS = "doc_id long, text string, source string, _host string, _salt int, _bad string, _KEY string"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, folder, name):
    ok, note = compare(spark, duck(folder), folder, QUERIES[name], SQL[name])
    assert ok, note


@pytest.mark.parametrize("name", ["op2_chat_rotation", "op3_decontamination", "op9_line_dedup"])
def test_native_plans_have_no_python(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def page(i, text, host="a"):
    return (i, text, host, "x", 1, "y", "z")


def test_line_dedup_edges(spark):
    line = "menu of the site"
    data = [page(i, f"{line}\nbody {i}\n {line} \n\nend {i}") for i in range(8)]
    data += [page(20 + i, f"{line}\nother", "b") for i in range(3)]       # too few pages for boilerplate
    data += [page(30 + i, "copied page\nof two lines", "c") for i in range(40)]  # copies count as one page
    data += [page(40 + i, f"{line} x\nnull host {i}", None) for i in range(6)]
    data += [page(None, None), page(50, ""), page(51, line), page(51, line), page(52, "word " * 60_000)]
    out = linededup.drop_boilerplate(spark.createDataFrame(data, DOCS), ratio=0.4, dropped="n")
    assert out.columns == [*spark.createDataFrame([], DOCS).columns, "n"]
    got = rows(out, "doc_id", "source", "text", "n")
    assert (0, "a", "body 0\n\nend 0", 2) in got
    assert (20, "b", f"{line}\nother", 0) in got and (30, "c", "copied page\nof two lines", 0) in got
    assert (40, None, "null host 0", 1) in got
    assert (None, "a", None, 0) in got and (50, "a", "", 0) in got and got.count((51, "a", "", 1)) == 2
    assert (52, "a", "word " * 60_000, 0) in got
    assert linededup.drop_boilerplate(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("share", [0.011, 0.02, 0.05])
def test_line_dedup_on_few_pages_of_a_large_host(spark, share):
    """Boilerplate on 1 to 5 % of a large host's pages goes, in each language; rarer and other hosts' lines stay."""
    n, notes = 6000, ["All rights reserved.", "Tous droits réservés."]
    data = [page(i, "\n".join([f"first {i}", *(x for k, x in enumerate(notes) if i % int(1 / share) == k), f"last {i}"])) for i in range(n)]
    data += [page(n + i, f"rare line\nbody {i}") for i in range(n // 200)]
    data += [page(2 * n + i, f"{notes[0]}\nsmall host {i}", "b") for i in range(4)]
    out = linededup.drop_boilerplate(spark.createDataFrame(data, DOCS), dropped="n")
    got = {r.doc_id: (r.text, r.n) for r in out.collect()}
    assert len(got) == len(data)
    for i, text, host, *_ in data:
        gone = [x for x in text.split("\n") if host == "a" and x in notes]
        assert got[i] == ("\n".join(x for x in text.split("\n") if x not in gone), len(gone))


def test_line_dedup_by_host_where_lists_are_large(spark):
    """Without a broadcast the lists join by host, with the same result."""
    data = [page(i, f"menu\nbody {i}", host) for i, host in enumerate(["a"] * 500 + ["b"] * 20 + [None] * 20)]
    docs = spark.createDataFrame(data, DOCS)
    want = rows(linededup.drop_boilerplate(docs), "doc_id", "text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = linededup.drop_boilerplate(docs)
        assert "SortMergeJoin" in out._jdf.queryExecution().toString() and rows(out, "doc_id", "text") == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, block string, ck string"
    data = [(1, 2, "ann", "Hi <|end|> there", "", ""), (1, 1, "bob", "yo", "", ""), (1, 1, "bob", "yo", "", ""), (1, 0, "system", "rules", "", ""),
            (1, None, None, None, "", ""), (2, 0, "system", "alone", "", ""), (None, 5, "ann", "é" * 100_000, "", ""), (None, 5, "bob", "tie", "", "")]
    got = {(r.conv_id, r.perspective): r for r in chat.rotate(spark.createDataFrame(data, schema)).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (None, "bob")}
    ann = got[1, "ann"]
    assert ann.dialogue == ("<|system|>\nrules<|end|>\n<|user:bob|>\nyo<|end|>\n<|assistant|>\nHi < |end|> there<|end|>\n"
                            "<|user:unknown|>\n<|end|>\n")
    spans = [tuple(map(int, s.split("-"))) for s in ann.spans.split(",")]
    assert [ann.dialogue[a:b] for a, b in spans] == ["Hi < |end|> there<|end|>"]
    assert got[1, "unknown"].dialogue.endswith("<|assistant|>\n<|end|>\n") and got[None, "ann"].n_turns == 2
    assert chat.rotate(spark.createDataFrame([], schema)).count() == 0


def test_long_conversations_come_in_pieces(spark):
    n = 2 * chat.PIECE + 10
    df = spark.range(n).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"),
                               F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    got = [r for r in chat.rotate(df).orderBy("piece").collect() if r.perspective == "a"]
    assert [r.n_turns for r in got] == [chat.PIECE, chat.PIECE, 10]
    text = "".join(r.dialogue for r in got)
    assert [int(x.split("\n")[1].split("<")[0][1:]) for x in text.split("<|end|>\n")[:-1]] == list(range(n))
    # Many turns that share one number are ordered too.
    assert chat.numbered(df.withColumn("turn", F.lit(None).cast("long"))).select("position").distinct().count() == n


QUESTION = "A train leaves the old station at 7 and travels for 3 hours at 80 km per hour until Berlin appears, so how far did Anna go in 3 hours"


def test_decontamination(spark):
    fill = " ".join(f"filler{i} word" for i in range(40))
    again = QUESTION.replace("7", "9").replace(" 3 ", " 5 ").replace("80 km", "60 miles").replace("Berlin", "Paris").replace("Anna", "Maria")
    uneven = again.replace("in 5 hours", "in 6 hours")  # one value of the item for two of the document
    docs = [(1, f"{fill} {QUESTION} {fill}"), (2, f"{fill}\n{again}. {fill}"), (3, f"{fill} {uneven}"), (4, fill), (5, None), (6, ""),
            (7, "short text"), (8, QUESTION.upper()), (None, QUESTION), (9, f"{fill} {QUESTION}"), (9, f"{fill} {QUESTION}"), (9, "else"),
            (10, fill * 300 + QUESTION)]
    d = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, item_id long, w string")
    b = spark.createDataFrame([(1, QUESTION, "x"), (1, QUESTION, "y"), (2, None, ""), (3, "too short", ""), (None, "", "")],
                              "item_id long, text string, doc string")
    got = rows(decontam.leaks(d, b), "doc_id", "item_id")
    assert got == sorted([(1, 1), (2, 1), (8, 1), (None, 1), (9, 1), (10, 1)], key=repr) or set(got) - {(8, 1)} == {(1, 1), (2, 1), (None, 1), (9, 1), (10, 1)}
    assert (3, 1) not in got
    left = decontam.remove_contaminated(d, b)
    assert left.columns == d.columns
    assert {3, 4, 5, 6, 7, 9} <= {r.doc_id for r in left.collect()} and not {1, 2, 10, None} & {r.doc_id for r in left.collect()}
    assert decontam.leaks(d.limit(0), b).count() == 0 and decontam.leaks(d, b.limit(0)).count() == 0


def test_decontamination_of_long_runs_of_names_and_numbers(spark):
    """A row of names or a chain of numbers of any length is one slot."""
    names = " ".join(("Ann", "Bertha", "Cy")[i % 3] for i in range(40_000))
    chain = ",".join(str(i) for i in range(40_000))
    frame = "the old {} gave {} of the large boxes to all people of that small town on one cold day"
    d = spark.createDataFrame([(1, frame.format(names, "12")), (2, frame.format("Ann", chain)), (3, names), (4, chain)], "doc_id long, text string")
    b = spark.createDataFrame([(7, frame.format("Mary Jane", "7"))], "item_id long, text string")
    assert rows(decontam.leaks(d, b), "doc_id", "item_id") == [(1, 7), (2, 7)]
    assert [len(r.w) for r in d.select(decontam.template_words(F.col("text")).alias("w")).collect()] == [20, 20, 1, 1]
    assert [len(r.r) for r in d.select(decontam.raw_words(F.col("text")).alias("r")).collect()] == [20, 20, 1, 1]


def test_decontamination_of_numbers_and_short_items(spark, monkeypatch):
    """Items whose windows are mostly placeholders, or shorter than a window, are found as they stand."""
    sums = "Calculate 12 + 7 * 3 - 5 / 2 + 8 * 14 - 6 and 9"
    mixed = "Add up these numbers that stand in the list below please 4 8 15 16 23 42 99 108 7 31"
    fill = " ".join(f"filler{'abcdefghij'[i % 10]} word" for i in range(40))
    docs = [(1, f"{fill} {sums} {fill}"), (2, f"{fill} {sums.replace('7', '8')} {fill}"), (3, "Ask: what is love today?"), (4, "what is 2"),
            (5, f"{fill} list below please 4 8 15 16 23 42 99 108 7 31 {fill}"), (6, f"{fill} {mixed.replace('42', '43')}"), (7, fill), (8, None), (9, "is love"),
            (10, f"{fill} list below please 5 8 15 16 24 42 98 108 7 31 {fill}"), (11, "Love is what"), (12, f"{fill} {sums.replace(' and 9', '')}")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, sums), (2, "What is love"), (3, "what is love"), (4, mixed), (5, None), (6, "")], "item_id long, text string")
    want = [(1, 1), (3, 3), (5, 4), (6, 4), (12, 1)]
    assert rows(decontam.leaks(d, b), "doc_id", "item_id") == sorted(want, key=repr)
    assert rows(decontam.leaks(d, b.where("item_id = 4")), "doc_id", "item_id") == [(5, 4), (6, 4)]
    assert rows(decontam.remove_contaminated(d, b), "doc_id") == sorted([(i,) for i in (2, 4, 7, 8, 9, 10, 11)], key=repr)
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert rows(decontam.leaks(d, b), "doc_id", "item_id") == sorted(want, key=repr)


def test_windows_by_shuffle_give_the_same(spark, folder, monkeypatch):
    first = rows(decontam.op3_decontamination(spark, folder), "doc_id", "item_id", "n_windows")
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert first and rows(decontam.op3_decontamination(spark, folder), "doc_id", "item_id", "n_windows") == first


def test_names_at_sentence_starts_and_of_two_words(spark):
    item = ("Tom has 12 apples and buys 5 more. Tom gives 3 apples to Anna Smith. How many apples does Tom have when Anna Smith eats "
            "all that she got?")
    fill = " ".join(f"filler{'abcdefghij'[i % 10]} word" for i in range(40))

    def again(tom, anna, n="12"):
        return f"{fill} {item.replace('Tom', tom).replace('Anna Smith', anna).replace('12', n)} {fill}"
    docs = [(1, again("Bob", "Maria", "40")), (2, again("Jean Luc", "Zoë", "7")), (3, again("Bob", "Maria").replace("does Bob", "does Karl")),
            (4, again("Tom", "Anna Smith")), (5, fill), (6, again("the man", "a woman"))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert rows(decontam.leaks(d, b), "doc_id") == [(1,), (2,), (4,)]
