"""HTML extraction, BPE, chat formatting, decontamination and top-k against plain code."""

import hashlib
import html
import random
import re
from array import array

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evergreen.llm import bpe, chat, decontaminate, html_text, topk
from evergreen.llm.queries import oracle_sql

BODY = "<p>First part of the story goes on here, with &amp; and&nbsp;more.</p>\n<p>Second <b>bo</b>ld\n  part &lt;x&gt;.<br>Third</p>"
TEXT = "First part of the story goes on here, with & and more. Second bold part <x>. Third"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T t</title></head><body><nav><a href='/'>Home page</a></nav><article>{BODY}</article><footer>f f f</footer>",
        f"<body><div class='site-menu'><ul><li>One two<li>Three</ul></div><div id=content>{BODY}</div><div class=\"user-comments\"><div>I like it so much</div> me too</div>",
        f"<header><h1>Site name</h1></header><main>{BODY}<aside>Read also this other one</aside></main><form><p>Your mail</p></form>",
        f"<script>var a='<p>no</p>';</script><style>p{{}}</style><!-- <p>not this</p> --><section>{BODY}</section><div hidden>secret</div>",
        f"<div class='cookieNotice'>We use cookies</div><div>{BODY}</div><p class=advert>Buy now<p class=\"share\">Tell friends</p>",
        f"<nav>Menu without an end<article>{BODY}</article>",
    ],
)
def test_article_text(page):
    weights = html_text.Weights(1.0, {"p": -0.1, "br": -0.1, "b": -0.1}, -1.0)
    assert html_text.extract(page, weights) == TEXT


@pytest.mark.parametrize(
    "wrapped",
    [
        '<div class="page has-sidebar">{}</div>',
        '<article><section id="social-impact">{}</section></article>',
        '<article><div class="legal">{}</div></article>',
        '<article><figure><figcaption>{}</figcaption></figure></article>',
        '<article><div title="a hidden gem" data-note="display: none">{}</div></article>',
        '<div class="ad sidebar">Buy this now</div><div>{}</div><div class="comments">' + "I like it " * 30 + "</div>",
        '<div aria-hidden=true style="color:red">x y</div><div>{}</div><div style="color:red; display:none">z z z z</div>',
    ],
)
def test_hints_in_names_delete_nothing(wrapped):
    weights = html_text.Weights(1.0, {"p": -0.1, "br": -0.1, "b": -0.1}, -1.0)
    assert html_text.extract(f"<body>{wrapped.format(BODY)}</body>", weights) == TEXT


def test_hints_inside_an_article_keep_its_parts():
    """A heading and a paragraph of loose names between long parts."""
    weights = html_text.Weights(1.0, {"p": -0.1, "br": -0.1, "b": -0.1}, -1.0)
    page = f'<article>{BODY * 4}<h2 id="related-work">Related work</h2><p class="notice-period">Two weeks</p>{BODY * 4}</article>'
    text = html_text.extract(page, weights)
    assert text == " ".join([*[TEXT] * 4, "Related work Two weeks", *[TEXT] * 4])


def test_best_run_is_the_maximum_over_all_runs():
    rng = random.Random(4)
    weights = html_text.Weights(1.0, {"p": -0.5, "li": -3.0}, -2.0)
    for _ in range(200):
        tokens = [(None, "w " * rng.randint(0, 4), False) if rng.random() < 0.5 else (rng.choice(["p", "li", "div"]), "", False) for _ in range(14)]
        value = [weights.word * len(x.split()) if t is None else weights.tags.get(t, weights.unknown_tag) for t, x, _ in tokens]
        start, stop = html_text.best_run(html_text.Page(tokens, 0), weights)
        most = max([0.0, *(sum(value[i:j]) for i in range(14) for j in range(i + 1, 15))])
        assert sum(value[start:stop]) == pytest.approx(most)


def test_pages_with_odd_html(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "no tags &amp at all"), (4, "u", "no tags &amp at all"),
            (5, "u", "<a" * 2000), (6, "u", "<p>" + "word " * 100_000), (7, "u", "a < b <"), (8, "u", "<div class='x")]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r["text"] for r in html_text.extract_pages(pages, html_text.fit(pages)).collect()}
    assert got[1] == got[2] == got[3] == "" and got[4] == "no tags & at all" and got[7].startswith("a < b")
    assert len(got[6]) == 499_999
    assert html_text.extract_pages(pages.filter("false"), html_text.Weights()).count() == 0


def test_weights_from_labelled_pages(spark):
    page = f"<html><head></head><body><div><ul><li>a</li><li>b</li></ul></div><article>{BODY * 3}</article></body></html>"
    pages = spark.createDataFrame([(i, page) for i in range(20)], "page_id long, html string")
    w = html_text.fit(pages)
    assert w.word > 0 and w.tags["li"] < w.tags["p"] < 0 and w.tags["ul"] < 0


LONG = "<p>First part of the story goes on here, with more to tell and much to say about it.</p><p>Second part of it.</p>"
LONG_TEXT = "First part of the story goes on here, with more to tell and much to say about it. Second part of it."
REMARK = "I like this so much that I have to write a very long comment here. " * 20
ROWS = "<table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table><p>End of it.</p>"
SHAPES = {
    "comments by id": (f'<article>{LONG}</article><div id="comments">{REMARK}</div>', "{}"),
    "comments without an article": (f'<div>{LONG}</div><div id="comments"><p>{REMARK}</p></div>', "{}"),
    "comments as articles": (
        f'<div>{LONG}</div><div id="comments"><ol class="commentlist"><li><article class="comment-body"><p>{REMARK}</p></article></ol></div>', "{}"),
    "list of comments": (f'<main>{LONG}</main><ol class="commentlist"><li>{REMARK}</ol>', "{}"),
    "notice": (f'<div class="notice">We will be closed on some days.</div><div>{LONG}</div>', "{}"),
    "cookies": (f'<div>{LONG}</div><div class="cookie-banner">We use cookies to be better.</div>', "{}"),
    "table in an article": (f"<article>{LONG}{ROWS}</article>", "{} a 1 b 2 End of it."),
    "table": (f"<div>{LONG}{ROWS}</div>", "{} a 1 b 2 End of it."),
    "list at the end": (f"<div>{LONG}<ul>" + "".join(f"<li>item {i}</li>" for i in range(8)) + "</ul></div>",
                        "{} " + " ".join(f"item {i}" for i in range(8))),
    "short list in an article": (f"<article>{LONG}<ul>" + "".join(f"<li>{i}</li>" for i in range(8)) + "</ul></article>", "{} 0 1 2 3 4 5 6 7"),
    "paragraph of links": (f"<div>{LONG}<p><a href=x>one two</a> <a href=y>three</a> <a href=z>four</a></p></div>", "{} one two three four"),
    "a name that only hints": (f'<article>{LONG}<div class="related-media"><p>A caption of it.</p></div><p>End of it.</p></article>',
                               "{} A caption of it. End of it."),
    "sidebar without an end": (f'<div class="sidebar"><p>Side.</p><article>{LONG}</article>', "{}"),
    "aside without an end": (f"<body><aside><div><p>{LONG}</div></body>", "{}"),
    "image that ends itself": (f"<div><svg width=1 />{LONG}</div>", "{}"),
    "object without an end": (f"<div><object data=x>{LONG}</div>", "{}"),
    "formula": (f"<article>{LONG}<math><mi>x</mi></math></article>", "{} x"),
    "menu element in an article": (f"<article>{LONG}<menu><li>One thing</li></menu></article>", "{} One thing"),
    "ad within a line": (f'<article>{LONG}<p>In 300 <span class="ad">AD</span> it was.</p></article>', "{} In 300 AD it was."),
    "two roles": (f'<div role="search article">{LONG}</div>', "{}"),
    "title in a header": (f"<article><header><h1>The title</h1></header>{LONG}</article>", "The title {}"),
    "advert inside": (f'<article>{LONG}<div class="ad">Buy this thing now, it is good.</div>{LONG}</article>', "{0} {0}"),
    "advert inside without an article": (f'<div>{LONG}<div class="ad">Buy this thing now, it is good.</div>{LONG}</div>', "{0} {0}"),
    "menus that only their links tell": (
        f"<div><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></div><div>{LONG}</div><div><ul><li><a href=/x>Other story</a></ul></div>", "{}"),
    "page in a form": (f"<form id=f><div>{LONG}</div><input></form>", "{}"),
    "short blocks": (f"<div>{LONG}" + "<div>one more</div>" * 3 + "</div>", "{} one more one more one more"),
}


@pytest.fixture(scope="module")
def learned_weights(spark):
    return html_text.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes_of_pages_with_learned_weights(learned_weights, shape):
    page, text = SHAPES[shape]
    assert html_text.extract(f"<!DOCTYPE html><html><body>{page}", learned_weights) == text.format(LONG_TEXT)


def test_the_scan_decides_and_gives_the_article(spark, learned_weights):
    """Against the plain text of the article element, of which these pages have one without anything else in it."""
    w, rows = learned_weights, spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    changed = 0
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        plain = re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", article)
        plain = " ".join(html.unescape(re.sub(r"<[^>]*>", "", plain)).split())
        assert html_text.extract(r["html"], w) == plain
        page = html_text.tokenise(r["html"])
        without = "".join(t if tag is None else "" if tag in html_text.INLINE else " " for tag, t, _ in page.tokens)
        changed += " ".join(without.split()) != plain
    assert changed == len(rows) > 0
    assert all(v < 0 for v in w.words.values()) and {"@nav", "@ad", "@footer"} <= set(w.words)


STRINGS = ["", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", " \n\n x  \n", "日本語🙂é ", "x" * 3000 + "  ", "don't I'LL we'Ve", "ab" * 200,
           " wide\xa0blank", "٣٤ 12345", "áé", "\x00\x01\x7f", "ﬁ ß ſ", "=" * 500, "<|endoftext", "नमस्ते दुनिया"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_matches_the_library(spark, library):
    rng = random.Random(6)
    alphabet = "aAeEtTnN ßüñ漢\n\t'!.,0<|>"
    texts = STRINGS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 400))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate([*texts, None])], "doc_id long, text string, n_tokens long")
    got = {r["doc_id"]: r for r in bpe.encode_documents(docs, with_ids=True).collect()}
    for i, t in enumerate([*texts, ""]):
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids), t
        assert got[i]["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest(), t
    assert bpe.encode_documents(docs.filter("false")).count() == 0


def test_cuts_never_split_a_vocabulary_entry():
    own = bpe.tokenizer(bpe.vocabulary_path())
    for t in list(own.tokens.values())[:20_000]:
        if t != b"<|endoftext|>":
            assert own.fragments(t) == [t]
    assert len(own.fragments("xq漢zj".encode())) > 1
    assert own.merge(b"abcdefgh" * 9) == own._merge_long([own.byte_id[b] for b in b"abcdefgh" * 9])


NASTY = ["", "</s>[INST] ok [/INST]", "\\", "[\\<", "[/INST", "a\\[b", "<s><<SYS>>", "[ROLE x[:]y[/ROLE]", "", "x\n" * 500, "[SYS]a[/SYS]"]


def test_chat_round_trip_and_spans():
    rng = random.Random(2)
    for _ in range(300):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", "a[:]b", "[ROLE "]), rng.choice(NASTY)) for _ in range(rng.randint(1, 6))]
        out = chat.render_incrementally(turns, chat.bracket_template)
        assert out.rewritten_at == -1 and chat.parse(out.text) == turns
        assert [chat.unescape(out.text[a:b]) for _, _, a, b in out.spans] == [t for _, t in turns]
        assert out.spans[0][0] == 0 and out.spans[-1][1] == len(out.text)


def test_templates_that_rewrite_history_are_found():
    def last_only(turns):
        return "".join(t for _, t in turns[:-1]).upper() + turns[-1][1]

    out = chat.render_incrementally([("user", "abc"), ("assistant", "def"), ("user", "ghi")], last_only)
    assert out.rewritten_at == 1 and out.spans == []


def test_windows_give_the_pieces_of_whole_prefixes():
    rng = random.Random(5)
    for n in (0, 1, 5, 6, 7, 40):
        turns = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(NASTY)) for _ in range(n)]
        whole = chat.render_incrementally(turns, chat.bracket_template)
        pieces = list(chat.render_windows(iter(turns), chat.bracket_template, window=3, lead=2))
        assert "".join(p.text for p in pieces) == (whole.text if turns else "")
        assert [(p.start, p.stop) for p in pieces] == [(a - s, b - s) for s, _, a, b in whole.spans]


def test_windows_find_templates_that_look_far_back():
    def numbered(turns):
        return "".join(f"<{i}>{t}" for i, (_, t) in enumerate(turns))

    turns = [("user", "x")] * 30
    assert chat.render_incrementally(turns, numbered).rewritten_at == -1
    assert list(chat.render_windows(turns, numbered, window=8, lead=4))[12:] == [None]
    assert None not in list(chat.render_windows(turns[:12], numbered, window=8, lead=4))


def test_chat_holds_a_window_of_a_long_conversation():
    """The widest prefix that the template ever sees, and how many of them, stay in proportion."""
    seen = []

    def template(turns):
        seen.append(len(turns))
        return chat.bracket_template(turns)

    assert sum(1 for _ in chat.render_windows((("user", "x") for _ in range(2000)), template)) == 2000
    assert max(seen) <= chat.WINDOW + chat.LEAD and sum(seen) < 2000 * 2 * (chat.WINDOW + chat.LEAD)


def test_chat_query_renders_every_whole_prefix(monkeypatch):
    seen, template = [], chat.bracket_template

    def spy(turns, **more):
        seen.append(list(turns))
        return template(turns, **more)

    monkeypatch.setattr(chat, "bracket_template", spy)
    turns = [(("user", "assistant", "tool")[i % 3], f"{NASTY[i % len(NASTY)]} {i} \ue000") for i in range(100)]
    got = chat.digest(7, iter(turns))
    assert all(turns[:k] in seen for k in range(1, 101))
    assert all([*turns[:k], (turns[k][0], chat.PROBE * 2)] in seen for k in range(100))
    assert got[1] == 100 and got[5] == len(template(turns)) and not got[6]
    assert got[2] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_prefixes_of_templates_that_look_far_back():
    """The first turn's text and the number of turns before stand in every turn: nothing is rewritten."""

    def template(turns):
        return "".join(f"<{turns[0][1]} {i}>{t}" for i, (_, t) in enumerate(turns))

    turns = [("user", f"x{i}") for i in range(60)]
    pieces = list(chat.render_prefixes(iter(turns), template))
    assert "".join(p.text for p in pieces) == template(turns)
    assert [p.text[p.start : p.stop] for p in pieces[1:]] == [t for _, t in turns[1:]]


def test_chat_of_one_long_conversation(spark):
    n = 20_000
    rows = spark.range(n).select(
        F.lit(None).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("<s> ["), "id").alias("text"),
    )
    (got,) = chat.format_conversations(rows).collect()
    turns = "".join(f"{'assistant' if i % 2 else 'user'}\n<s> [{i}\n" for i in range(n))
    loss = "".join(f"<s> [{i}" for i in range(1, n, 2))
    assert got["n_turns"] == n and got["loss_chars"] == len(loss) and not got["rewrites_history"]
    assert got["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert got["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_query_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 1, None, "b"), (2, 0, "assistant", "[x"), (2, 0, "assistant", "[x"),
            (None, 0, "user", "q"), (3, None, "assistant", "late"), (3, 0, "assistant", "z")]
    table = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, n_turns string")
    got = {r["conv_id"]: r for r in chat.format_conversations(table).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\nhi\nassistant\n\n") and got[1]["loss_chars"] == 0
    assert got[2]["n_turns"] == 3 and got[2]["loss_sha256"] == sha("[x[x")
    assert got[2]["turns_sha256"] == sha("assistant\n[x\n" * 2 + "\nb\n")
    assert got[3]["loss_sha256"] == sha("latez") and got[None]["n_turns"] == 1
    assert chat.format_conversations(table.filter("false")).count() == 0


def leaks_by_hand(docs, items, shingle=5):
    def words(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    found = set()
    for item, text in items:
        w = words(text)
        n = min(shingle, len(w))
        own = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for doc, body in docs:
            b = words(body)
            has = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
            if own and 5 * len(own & has) >= 4 * len(own):
                found.add((doc, item, len(own & has), len(own)))
    return found


def test_leaks(spark):
    rng = random.Random(9)
    say = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    items = [(i, say(rng.choice([3, 5, 6, 12, 40, 70]))) for i in range(30)] + [(90, None), (91, ""), (92, "a a a a a a a a"), (93, "One, two")]
    docs = []
    for i in range(120):
        text = say(rng.randint(0, 200))
        if i % 2:
            w = rng.choice(items[:30])[1].split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = "changed"
            text = f"{text} {', '.join(w).upper()}. {say(50)}"
        docs.append((i, text))
    docs += [(200, None), (201, ""), (202, "a a a a a a"), (203, "x one TWO y"), (203, "x one TWO y"), (203, "other"), (204, "word " * 50_000)]
    d = spark.createDataFrame([(*r, 1, "s") for r in docs], "doc_id long, text string, item_id int, shared string")
    b = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, doc_id string")
    got = {tuple(r)[:4] for r in decontaminate.find_leaks(d, b).collect()}
    want = leaks_by_hand(docs, items)
    assert got == want and len(want) > 20
    kept = decontaminate.keep_clean(d, b)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {x[0] for x in want}
    assert decontaminate.find_leaks(d, b.filter("false")).count() == 0
    assert decontaminate.find_leaks(d.filter("false"), b).count() == 0


def test_decontamination_stays_native(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = decontaminate.find_leaks(d, b)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


@pytest.fixture
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.1, 8)).tolist()) for i in range(1500)]
    rows += [(2000 + i, centres[0].tolist()) for i in range(300)]
    rows += [(3000, None), (3050, [1.0, None] * 4), (3100, [float("nan")] * 8), (3150, [float("inf")] * 8), (3200, [1.0] * 3), (3250, []), (3251, [2.0] * 3)]
    rows += [(50, [0.5] * 8), (51, [0.25] * 8)]  # repeated ids
    return rows


def top_by_hand(rows, k=5):
    whole = [(i, np.floor(256 * np.array(v, dtype="f8")).astype(object)) for i, v in rows
             if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in whole:
        if q % 50 == 0:
            best = sorted(((-int((v * w).sum()) if len(v) else 0, i) for i, w in whole if i != q and len(w) == len(v)))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def test_topk(spark, vectors, monkeypatch):
    vectors = [r for r in vectors if r[0] != 50 or r[1] == [0.5] * 8]  # one row per query id
    want = sorted(top_by_hand(vectors))
    table = spark.createDataFrame([(i, v, 1, "q") for i, v in vectors], "vec_id long, embedding array<double>, rank int, part string")
    assert sorted(map(tuple, topk.search(table, F.col("vec_id") % 50 == 0).collect())) == want
    monkeypatch.setattr(topk, "GROUP_ROWS", 400)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    assert sorted(map(tuple, topk.search(table, F.col("vec_id") % 50 == 0).collect())) == want
    assert topk.search(table.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_of_very_large_components_and_repeated_queries(spark):
    def best(rows, k=5):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return sorted(tuple(r) for r in topk.search(table, F.col("vec_id") % 50 == 0, k).collect())

    top = (1 << 63) - 1
    for large in ([1e12, 1e12], [1e300, 1.0]):
        got = best([(0, large), (1, large), (2, large), (3, [-x for x in large]), (4, [0.0, 0.0])])
        assert got == [(0, 1, 1, top), (0, 2, 2, top), (0, 3, 4, 0), (0, 4, 3, -(1 << 63))]
    got = best([(50, [1 / 256]), (50, [1 / 256])] + [(i, [i / 256]) for i in range(1, 12)])
    want = [(50, r, v, v) for r, v in enumerate([11, 10, 9, 8, 7], 1)]
    assert got == sorted(want * 2)


def test_topk_beyond_exact_doubles(spark):
    rows = [(0, [7.0e12, 1.0]), (1, [6.0e12, 1.0]), (2, [6.0e12, 2.0]), (3, [6.0e12, 0.0])]
    table = spark.createDataFrame([(i, [x[0] / 1e6, x[1]]) for i, x in rows], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.search(table, F.col("vec_id") % 50 == 0).collect())) == top_by_hand([(i, [x[0] / 1e6, x[1]]) for i, x in rows])


def test_pruning_skips_blocks():
    seen = []

    class Spy(list):
        def __getitem__(self, i):
            seen.append(i)
            return super().__getitem__(i)

    blocks = Spy((np.arange(10) + 10 * b, np.full((10, 2), 100.0 - 10 * b)) for b in range(8))
    q = np.ones(2)
    bounds = np.array([200.0 - 20 * b for b in range(8)])
    assert topk.best_of((999, q), np.argsort(-bounds), bounds, blocks, 5) == [(200, i) for i in range(5)]
    assert seen == [0]


@pytest.mark.parametrize("name", ["op5_decontamination", "op8_topk", "op9_chat"])
def test_sql_agrees_on_the_smallest_tables(spark, name):
    from evergreen.llm.queries import queries

    d, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    got = queries()[name](spark, d)
    cur = con.execute(oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(map(tuple, cur.fetchall()), key=repr)


def test_batches_are_bounded_by_bytes(spark):
    from evergreen.llm.common import BATCH_LIMIT, map_rows

    before = spark.conf.getAll.get(BATCH_LIMIT)
    spark.conf.unset(BATCH_LIMIT)
    try:
        docs = spark.range(0, 400, 1, 1).selectExpr("repeat('word ', 20000) text")
        sizes = map_rows(docs, lambda: lambda texts: [[sum(map(len, texts))]], [("n", "long")])
        got = [r["n"] for r in sizes.collect()]
        assert sum(got) == 400 * 100_000 and max(got) < 10 << 20
        spark.conf.set(BATCH_LIMIT, "1m")  # a session's own limit stays
        assert max(r["n"] for r in map_rows(docs, lambda: lambda texts: [[sum(map(len, texts))]], [("n", "long")]).collect()) < 2 << 20
    finally:
        spark.conf.unset(BATCH_LIMIT)
        if before:
            spark.conf.set(BATCH_LIMIT, before)


def test_items_with_one_id_or_none_are_all_found(spark):
    """Texts of one id with equally many shingles, and items without an id."""
    text = lambda i, v: " ".join(f"w{v}x{i}x{k}" for k in range(15))
    items = [(i, text(i, v)) for i in range(60) for v in "ab"] + [(None, text(90, v)) for v in "ab"]
    docs = [(n, "before it " + t + " after it") for n, (_, t) in enumerate(items)] + [(None, text(0, "a"))]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(docs, items).collect()
    want = [(n, n // 2 if n < 120 else None) for n in range(122)] + [(None, 0)]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=key) == want
    assert all(r["shared"] == r["wanted"] == 11 and r["containment"] == 1.0 for r in got)
    assert [r["doc_id"] for r in decontaminate.keep_clean(docs, items).collect()] == [None]
