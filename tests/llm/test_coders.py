"""Tokenizers, token files, extraction and search next to brute force."""
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from tabulon.llm import bytebpe, common, mainpart, tokenfile, topk

TEXTS = ["", None, "The 'll cat's naïve  café\n\n  x", " lead", "trail ", "a\tb\r\n", "漢字 😀   nb", "éé é", "123 4567 $$ !!",
         "<|endoftext|> ok", "mark \x01 a\x01b \x1c \x1fc", "x" * 700, " " * 50, "word " * 30_000, "same", "same", "İΣß ǅ"]
SCHEMA = "doc_id long, text string, ids string, _given int, tie string, Decoded string"


def frame(spark, texts=TEXTS, ids=None):
    data = [((i if ids is None else ids[i]), t, "x", 1, "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def tik():
    import tiktoken
    ranks = bytebpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_edges(spark, tik):
    got = {r.doc_id: r for r in bytebpe.round_trip(frame(spark)).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = tik.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bytebpe.round_trip(frame(spark, [])).count() == 0


def test_byte_bpe_keeps_other_columns(spark, tik):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    coded = bytebpe.encode(frame(spark), path, P.PATTERN)
    assert coded.columns == ["doc_id", "text", "_given", "tie", "Decoded", "ids"]
    both = bytebpe.decode(coded, path, P.PATTERN, decoded="bytes")
    assert all(bytes(r["bytes"]).decode() == (r.text or "") for r in both.collect())


def test_byte_bpe_on_documents(spark, folder, tik):
    docs = {r.doc_id: r.text or "" for r in common.table(spark, folder, "documents").collect()}
    got = {r.doc_id: r.ids_sha256 for r in bytebpe.op5_byte_bpe(spark, folder).collect()}
    assert got == {i: hashlib.sha256(np.array(tik.encode_ordinary(t), "<u4").tobytes()).hexdigest() for i, t in docs.items()}


def test_generations_of_known_words(tik, monkeypatch):
    monkeypatch.setattr(bytebpe, "WORDS_KEPT", 3)
    coder = bytebpe.Bpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for text in ("one two three four", "two five", "six one seven", "two two one", ""):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == tik.encode_ordinary(text)


def expected_file(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return {text: t.encode(text or "", add_special_tokens=False).ids + [1] for _, text in rows}


def test_token_file_round_trip(spark, folder):
    docs = sorted((r.doc_id, r.text) for r in common.table(spark, folder, "documents").collect())
    want, start, ids = {}, 0, expected_file(docs)
    for i, t in docs:
        want[i] = (i, start, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes()))
        start += len(ids[t])
    assert {r[0]: tuple(r) for r in tokenfile.op8_token_file(spark, folder).collect()} == want


def test_token_file_edges(spark):
    ids = [7, None, 7, 3, 3, -5, *range(100, 100 + len(TEXTS) - 6)]
    df, path = frame(spark, TEXTS, ids), P.path("word_bpe_49k.json")
    file = common.shared_folder(spark, "test-file")
    tokenfile.write(tokenfile.token_ids(df, path, 1), file, "<u2", 4)
    got = [(r.doc_id, r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in tokenfile.read(spark, file).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [g[1] for g in got] == np.cumsum([0] + [len(g[2]) for g in got[:-1]]).tolist()
    codes = expected_file(list(zip(ids, TEXTS)))
    assert sorted((repr(g[0]), g[2]) for g in got) == sorted((repr(i), codes[t]) for i, t in zip(ids, TEXTS))
    empty = common.shared_folder(spark, "test-file")
    tokenfile.write(tokenfile.token_ids(frame(spark, []), path, 1), empty, "<u2")
    assert tokenfile.read(spark, empty).count() == 0


def test_token_file_with_added_tokens(spark, tmp_path, monkeypatch):
    """The ids of op8 are those of the library's plain call."""
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    texts = ["a <|endoftext|> b", "x<|endoftext|>y <|startoftext|><|startoftext|> z", "<|ENDOFTEXT|> <|endoftext |>", "<|endoftext|>", "a b x y z", "\x01 <|endoftext|> \x01", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plain, want, start = Tokenizer.from_file(path), [], 0
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in tokenfile.op8_token_file(spark, str(tmp_path)).collect()) == want
    monkeypatch.setattr(tokenfile.WordIds, "TOGETHER", 2)
    coder = tokenfile.WordIds(path, True)
    for _ in range(2):
        assert [np.frombuffer(x, coder.type).tolist() for x in coder([t or "" for t in texts], 1)] == [
            plain.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_range_coder_blocks_and_checkpoints():
    rng = np.random.default_rng(1)
    x = (rng.zipf(1.3, 100_000) % 3000).astype(np.uint32)
    counts = np.bincount(x)
    freq = np.where(counts > 0, counts * ((1 << 20) - len(counts)) // counts.sum() + 1, 0)
    freq[freq.argmax()] += (1 << 20) - freq.sum()
    coder = tokenfile.Coder(freq.astype(np.uint32))
    for n in (0, 1, 255, 256, 257, tokenfile.LANES * tokenfile.STEPS, 100_000):
        states, places, words = coder.encode(x[:n])
        assert (coder.decode(states, places, words, n) == x[:n]).all()
    # The second checkpoint alone gives the ids from there on, and the file is close to the entropy.
    span = tokenfile.LANES * tokenfile.STEPS
    s, p, w = np.frombuffer(states, "<u8").reshape(-1, tokenfile.LANES), np.frombuffer(places, "<u4"), np.frombuffer(words, "<u4")
    assert (coder.decode_from(s[1], w.astype(np.uint64)[p[1]:], span) == x[span:2 * span]).all()
    q = counts[counts > 0] / counts.sum()
    assert len(words) * 8 < 1.02 * len(x) * -(q * np.log2(q)).sum()


def test_a_damaged_block_is_noticed(spark):
    file = common.shared_folder(spark, "test-file")
    tokenfile.write(tokenfile.token_ids(frame(spark), P.path("word_bpe_49k.json"), 1), file, "<u2", 2)
    blocks = spark.read.parquet(f"{file}/blocks").withColumn("crc32", F.col("crc32") + 1)
    bad = common.shared_folder(spark, "test-file")
    blocks.write.parquet(f"{bad}/blocks")
    spark.read.parquet(f"{file}/table").write.parquet(f"{bad}/table")
    with pytest.raises(Exception, match="damaged"):
        tokenfile.read(spark, bad).collect()


PAGE = """<html><head><title>t</title><script>if (a<b) {x="</p>"}</script></head><body><header>Site</header>
<div id="top-menu"><a href=x>Home</a></div><div class='cookie-notice'>We use cookies</div><article class="post"><h1>Head &amp; line</h1>
<p>First <b>bold</b>x paragraph &lt;1&gt; &amp;amp; with enough text to be a surge of the distribution, surely more than a line.<p>To.</p>
<ul><li>one<li>two</ul><div class="ad"><div>buy</div> now</div><p>last<br>line</p><section class=comments><p>me too</p></section></article>
<aside>side</aside><form><p>mail</p></form><footer>&copy; us</footer></body>"""


def test_main_text_edges(spark):
    want = ("Head & line\nFirst boldx paragraph <1> &amp; with enough text to be a surge of the distribution, surely more than a line.\n"
            "To.\none\ntwo\nlast line")
    data = [(1, "u", PAGE, 0, "t"), (2, "u", None, 0, "t"), (2, "u", "", 0, "t"), (3, None, "<p>unclosed <!-- comment", 0, "t"),
            (4, "u", "plain text only", 0, "t"), (5, "u", "<article><p>" + "long text " * 50_000 + "</p></article>", 0, "t"),
            (6, "u", "<nav>only menu</nav>", 0, "t"), (7, "u", "<main><p>in main</p></main><p>outside " + "o" * 200 + "</p>", 0, "t")]
    df = spark.createDataFrame(data, "page_id long, url string, html string, _html int, Text_ string")
    out = mainpart.extract(df)
    assert out.columns == ["page_id", "url", "html", "_html", "Text_", "text"]
    got = sorted((r.page_id, r.text) for r in out.collect())
    assert got == [(1, want), (2, ""), (2, ""), (3, "unclosed"), (4, "plain text only"), (5, ("long text " * 50_000).strip()), (6, ""), (7, "in main")]
    assert mainpart.extract(df.limit(0)).count() == 0


def test_main_text_without_an_article_element():
    body = "<p>" + "a sentence of the story " * 8 + "</p>"
    page = f'<div><a href="/">Home</a> <a href="/n">News</a></div>{body}<p>To.</p>{body}<div class="sidebar">{body}</div><section id="comments">{body}'
    assert mainpart.main_text(page).split("\n") == [body[3:-4].strip(), "To.", body[3:-4].strip()]


@pytest.mark.parametrize("open_, close", [
    ("<div class='content-sidebar-wrap'>", "</div>"), ("<div class='page has-sidebar'>", "</div>"), ("<section class='post no-comments'>", "</section>"),
    ("<div id='x' class='site-header-fixed layout'><div class='content-sidebar-wrap'>", "</div></div>"),
    ("<article class='post comments-open'>", "</article>"), ("<main class='with-comments'>", "</main>"),
    ("<table class='menu-left-layout'><tr><td>", "</td></tr></table>"), ("<body class='comments-page'>", "</body>")])
def test_main_text_inside_wrapper_classes(open_, close):
    body = "<p>" + "a sentence of the story " * 8 + "</p>"
    page = (f"<div class='top-menu'><p>{'short words ' * 9}</p></div>{open_}<h1>Head</h1>{body}<div class='sidebar-primary'><p>{'side words ' * 9}</p></div>"
            f"<div class='widget'>{body}</div>{body}<div class='comment-list'>{body * 9}</div>{close}")
    assert mainpart.main_text(page).split("\n") == ["Head", body[3:-4].strip(), body[3:-4].strip()]


def test_a_marked_element_beside_an_article_is_no_wrapper():
    long = "<p>" + "we use cookies on this site " * 30 + "</p>"
    page = f"<div class='cookie-notice-text'>{long}</div><article><p>{'a story ' * 20}</p></article>"
    assert mainpart.main_text(page) == ("a story " * 20).strip()


def test_main_text_of_pages(spark, folder):
    import html
    import re
    for r in mainpart.op7_main_text(spark, folder).join(common.table(spark, folder, "pages"), ["page_id", "url"]).collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:h1|p)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def brute(rows, k, step):
    ok = {(i, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for i, q in ok:
        if i % step == 0:
            score = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(score)}
    return out


def test_top_k_edges(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, [1.0] * 6), rows[5], rows[50]]
    rows += [(500 + i, [1.0, 1.0]) for i in range(20)] + [(600, []), (650, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, block int, rank string")
    want = brute([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows], 5, 50)
    for block, asked in ((4096, 512), (40, 3)):
        got = {tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), block=block, query_block=asked).collect()}
        assert got == want
    few = spark.createDataFrame([(0, [1.0], 0, ""), (1, [2.0], 0, "")], df.schema)
    assert [tuple(r) for r in topk.top_k(few, few.where("vec_id = 0")).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df, df.limit(0)).count() == 0


def test_top_k_stops_early():
    """Vectors with few large components: reading ends before the lists do."""
    rng = np.random.default_rng(4)
    v = np.floor(256 * rng.exponential(size=(2000, 8)) ** 3)
    q = np.floor(256 * np.eye(8)[:4] + 1)
    a, b, s = topk.best_of_block(v, np.arange(2000), q, np.arange(4) + 5000, 5)
    full = v @ q.T
    for i in range(4):
        assert sorted(s[a == i]) == sorted(full[:, i])[-5:]


def test_repeated_rows_are_candidates_each(spark):
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0]), (2, [0.25, 9.0]), (3, [-1.0, 0.0])] + [(4, [0.125, 1.0])] * 9
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 128 * 256), (0, 2, 1, 128 * 256), (0, 3, 2, 64 * 256), (0, 4, 4, 32 * 256), (0, 5, 4, 32 * 256)]
    con = duckdb.connect()
    con.register("embeddings", df.toPandas())
    assert sorted(con.execute(topk.SQL).fetchall()) == got


def test_main_text_with_quotes_in_unquoted_values():
    body = "A paragraph that is long enough to be the text of a page, with a comma and some more words. " * 3
    page = f"<html><body><div><p title=it's>Don't lose this. {body}</p><p data-x=a\"b>{body}</p><p title=\"a>b\">{body}</p></div></body></html>"
    assert mainpart.main_text(page).split("\n") == [f"Don't lose this. {body.strip()}", body.strip(), body.strip()]


def test_a_worker_keeps_one_large_object(tmp_path, spark, monkeypatch):
    """Coders of two operators are not kept beside each other, tasks of other stages keep none, decoding goes by slices."""
    from tabulon.llm import simjoin

    first = bytebpe._bpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert bytebpe._bpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN) is first
    tokenfile._word_ids(P.path("word_bpe_49k.json"), True)
    assert [k[0] for k in common._held] == ["word ids"]
    list(simjoin._verify(0.8)(iter([])))
    assert not common._held
    monkeypatch.setattr(bytebpe, "IDS_AT_ONCE", 20)
    texts = ["", "one two three four five six seven eight nine ten", "a", "", "b c d e f g"]
    assert first.decode(first.encode(texts)) == [t.encode() for t in texts]
