"""BPE, chat, LM scores, HTML."""

import base64
import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from reportloom.llm import bpe, chat, html_main, lm_score

from .brute import LOWER, WORD

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(odd_docs, docs, library):
    for df in (odd_docs, docs):
        texts = {r.doc_id: r.text or "" for r in df.collect()}
        got = bpe.encode(df, PATH, public_tokenizers.PATTERN).collect()
        assert len(got) == df.count()
        for r in got:
            want = library.encode_ordinary(texts[r.doc_id])
            assert r.ids == want and r.n_tokens == len(want)
            assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_matrix_and_heap_agree():
    own = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    rnd = np.random.default_rng(5)
    pieces = [bytes(rnd.choice(list(b"aaabeinrst\xc3\xa9"), 24).astype(np.uint8)) for _ in range(300)]
    assert own.merge_matrix(pieces) == [own.merge_heap(p) for p in pieces]


def test_bpe_bounds_the_ranks_and_takes_no_rows(no_docs):
    with pytest.raises(ValueError):
        bpe.read_ranks(PATH, 1000)
    assert bpe.encode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


TALK = [
    (1, 0, "system", "be <|start|> kind"),
    (1, 1, "user", "␛0 ␛1 </s>[INST] ok [/INST] <<SYS>> <|im_end|> < |x|>"),
    (1, 2, "assistant", "</s>[INST] ok [/INST]"),
    (1, 3, None, None),
    (1, 4, "assistant", ""),
    (1, 5, "assistant", "tail\n漢字"),
    (2, None, "us<|sep|>er", "first"),
    (2, 1, "assistant", "tie a"),
    (2, 1, "assistant", "tie b"),
    (2, 1, "assistant", "tie b"),
    (None, 0, "user", "no conversation"),
]


def test_chat_reads_back_what_was_said(spark):
    df = spark.createDataFrame([(*r, "x") for r in TALK], "conv_id bigint, turn bigint, role string, text string, body string").repartition(5)
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(df)).collect()}
    assert len(got) == 3
    for conv in (1, 2, None):
        turns = sorted((-1 if t is None else t, role or "", text or "") for c, t, role, text in TALK if c == conv)
        said = "".join(x for _, role, x in turns if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_chat_escapes_every_control_string(spark):
    import re

    df = spark.createDataFrame(TALK, "conv_id bigint, turn bigint, role string, text string")
    for r in chat.format_turns(df).collect():
        assert not re.search(chat.CONTROL, r.body), r.body
        assert r.head.startswith(chat.START) and r.head.endswith(chat.SEP) and r.tail == chat.END
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_chat_visits_typed_parts(spark):
    df = spark.createDataFrame(
        [(1, 3, "user", [("text", "look </s>", None, None), ("image", None, "s3://x/1.png", 256), ("Audio", None, "a.wav", None), ("odd", "kept", None, 4)]), (1, 4, "user", None)],
        f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>",
    )
    first, second = sorted(chat.format_turns(df, "parts").collect(), key=lambda r: r.turn)
    assert first.body == "look <␛1/s><|image_3_1|><|audio_3_2|>kept" and first.attachment_tokens == 256
    assert [(a.part, a.kind, a.ref, a.mark) for a in first.attachments] == [(1, "image", "s3://x/1.png", "<|image_3_1|>"), (2, "audio", "a.wav", "<|audio_3_2|>")]
    assert second.body == "" and second.attachments == [] and not second.in_loss


def brute_scores(rows, order, min_count, backoff=0.4):
    own = [WORD.findall((t or "").translate(LOWER)) for _, t in rows]
    grams = Counter(tuple(w[i : i + n]) for w in own for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, own))

    def s(g):
        if len(g) == 1:
            return math.log(grams[g]) - math.log(total)
        return math.log(grams[g]) - math.log(grams[g[:-1]]) if grams[g] >= min_count else math.log(backoff) + s(g[1:])

    return [sum(s(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w))) for w in own], [len(w) for w in own]


@pytest.mark.parametrize("order,min_count", [(1, 1), (2, 2), (3, 1), (3, 2)])
def test_lm_scores(odd_docs, docs, order, min_count):
    for df in (odd_docs, docs):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        want, n = brute_scores(rows, order, min_count)
        got = lm_score.score(df, order=order, min_count=min_count).collect()
        key = lambda x: (x[0] is None, x[0] or 0, round(x[2], 4))
        for (d, words, total), r in zip(sorted(((d, k, s) for (d, _), s, k in zip(rows, want, n)), key=key), sorted(((r.doc_id, r.n_words, r.log_score) for r in got), key=key), strict=True):
            assert (d, words) == r[:2] and math.isclose(total, r[2], rel_tol=1e-9, abs_tol=1e-6)
        assert all((r.per_word is None) == (r.n_words == 0) for r in got)


def test_lm_of_nothing(no_docs):
    assert lm_score.score(no_docs).count() == 0


PARA = "This paragraph belongs to the article and has well over twenty words, so that any reader would take it for main text without a doubt."
PAGES = [
    ("", ""),
    (None, ""),
    ("<p", ""),
    ("<script>var a = '</p>';</script>", ""),
    (f"<html><head><title>t</title></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>Short.</p><p>{PARA}</p></article><footer>&copy; x</footer>", f"A & B\nShort.\n{PARA}"),
    (f"<header><h1>Site</h1></header><div class='cookie-notice'>We use cookies. {PARA}</div><main><p>{PARA}&nbsp; a &lt; b</p></main><aside>{PARA}</aside><form>{PARA}</form>", f"{PARA} a < b"),
    (f"<article><p>{PARA}<div id=comments><p>{PARA}</p></div><div class='ad'>{PARA}</div></article>", PARA),
    (f"<div id=menu><a href=a>One</a></div><p>{PARA}<p>{PARA}<b> bold</b><br>line</p><p>All rights reserved</p>", f"{PARA}\n{PARA} bold line"),
]


#: Names of containers and what they hold disagree: the text stands, whatever the wrapper is called.
NAMED_PAGES = [
    (f"<div class='layout has-sidebar'><article><h1>Name of it</h1><p>{PARA}</p></article><div class=sidebar><p>{PARA}</p></div></div>", f"Name of it\n{PARA}"),
    (f"<div class='nav-closed'><main><p>{PARA}</p><p>Short.</p></main></div>", f"{PARA}\nShort."),
    (f"<body class='with-comments'><div class='content no-ads'><p>{PARA}</p><p>{PARA}</p></div><div class=ad>{PARA}</div></body>", f"{PARA}\n{PARA}"),
    (f"<div class='layout has-sidebar'><article><p>{PARA}</p></article></div><section class=comments><article class=comment><p>{PARA}</p></article><article class=comment><p>So true.</p></article></section>", PARA),
    (f"<div class=cookie>{PARA}</div>", ""),
    (f"<article><header class='entry-header'><h1>A title</h1></header><p>{PARA}</p><p>Yes.</p><ul class=share><li><a href=a>Post</a><li><a href=b>Mail</a></ul></article>", f"A title\n{PARA}\nYes."),
    (f"<main><ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul><p>{PARA}</p></main>", PARA),
    (f"<article><p>{PARA}</p><div class=ad>Buy it now.</div><p>{PARA}</p><div class='sponsored'><p>{PARA}</p></div></article>", f"{PARA}\n{PARA}"),
    (f"<div class='page-with-sidebar'><p>{PARA}</p><p>{PARA}</p><div class=related><p><a href=x>Other one</a></p></div></div>", f"{PARA}\n{PARA}"),
    (f"<aside><article>{PARA}</article></aside><article class='has-comments'><p>{PARA} x</p><p>Short.</p></article>", f"{PARA} x\nShort."),
]
PAGES += NAMED_PAGES

def test_html(spark):
    rows = [(i, f"u{i}", h, "x") for i, (h, _) in enumerate(PAGES)] + [(4, "u4", PAGES[4][0], "x")]
    got = html_main.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"))
    seen = [(r.page_id, r.text, r.n_chars) for r in got.collect()]
    want = [(i, PAGES[i][1], len(PAGES[i][1])) for i, *_ in rows]
    assert sorted(seen) == sorted(want)
    assert html_main.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_html_of_the_whole_table(spark, sf_dir):
    """Every page against its article element, read by the parser of the standard library."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.skip, self.blocks = 0, 0, [[]]

        def handle_starttag(self, tag, attrs):
            named = any(k in ("class", "id") and v for k, v in attrs)
            if tag == "article":
                self.inside = 1
            elif self.skip and tag == "div" or tag == "div" and named or tag in ("script", "style", "form", "aside", "footer", "nav"):
                self.skip += 1
            if tag in ("p", "h1", "h2", "h3", "li", "ul", "div", "article"):
                self.blocks.append([])

        def handle_endtag(self, tag):
            if tag == "article":
                self.inside = 0
            elif self.skip and tag in ("div", "script", "style", "form", "aside", "footer", "nav"):
                self.skip -= 1
            if tag in ("p", "h1", "h2", "h3", "li", "ul", "div", "article"):
                self.blocks.append([])

        def handle_data(self, data):
            if self.inside and not self.skip:
                self.blocks[-1].append(data)

    got = {r.page_id: r for r in html_main.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        reader = Article()
        reader.feed(r.html or "")
        want = "\n".join(t for t in (" ".join("".join(b).split()) for b in reader.blocks) if t)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want)), r.page_id


def test_names_alone_decide_nothing():
    """The same name leaves text in a wrapper and drops it beside an article."""
    x, y = html_main.read_table()
    tree = html_main.grow(x, y)
    named = x[:, html_main.FEATURES.index("blocks_inside")] < html_main.MOST_INSIDE
    assert 0.2 < y[named].mean() < 0.8
    for name in ("has-sidebar", "ad", "comments"):
        alone = html_main.text_blocks(f"<div class='{name}'><p>{PARA}</p><p>{PARA}</p></div>")
        beside = html_main.text_blocks(f"<article><p>{PARA}</p></article><div class='{name}'><p>{PARA}</p><p>{PARA}</p></div>")
        assert (html_main.decide(tree, html_main.features(*alone)) >= 0.5).tolist() == [True, True]
        assert (html_main.decide(tree, html_main.features(*beside)) >= 0.5).tolist() == [True, False, False]


def test_tree_learns_its_table():
    x, y = html_main.read_table()
    assert ((html_main.decide(html_main.grow(x, y), x) >= 0.5) == y).all()
