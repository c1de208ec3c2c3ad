import itertools
import math
import time

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from bodega.llm import host_rules, main_text, pieces
from bodega.llm.queries import tokenizer

MODEL = tokenizer("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
OWN = pieces.PieceModel.load(MODEL)


def same_as_library(text):
    ids = LIBRARY.encode(text) + [LIBRARY.eos_id()]
    got = OWN.encode(text)
    assert got.ids == ids
    assert OWN.decode(ids, whole=True) == LIBRARY.decode(ids)
    n, ids_hash, text_hash, covered = OWN.digest(text)
    assert n == len(ids) and covered == len(text.encode())
    assert OWN.digest(text) == (n, ids_hash, text_hash, covered)
    # spans lie in order, leave nothing out and, but for bytes of one character, do not overlap
    data, at = text.encode(), 0
    for (begin, end), i in zip(got.spans, got.ids):
        assert begin == at or (begin, end) == before or (begin <= at and end == at)
        at = max(at, end)
        before = (begin, end)
        piece = OWN.pieces[i]
        if piece[2] == pieces.NORMAL:
            assert data[begin:end].decode().replace(" ", pieces.SPACE) == (piece[0] if begin else piece[0][-len(data[begin:end].decode()):] if end else "")
    assert at == len(data)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n▁ae漢🎉ß́<s>0"), st.characters(codec="utf-8")), max_size=60))
def test_any_text_is_encoded_as_the_library_does(text):
    same_as_library(text)


def test_given_texts_are_encoded_as_the_library_does(texts):
    for _, text in texts[:60]:
        same_as_library(text)
    same_as_library("ab" * 300)


def test_character_map_is_followed_as_the_library_does():
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = dict(pieces._fields(normalizer.serialized_normalizer_spec() if callable(getattr(
        normalizer, "serialized_normalizer_spec", None)) else dict(pieces._fields(normalizer.serialized_model_proto()))[3]))
    own = pieces.PieceModel([], pieces.CharacterMap(spec[2]), bool(spec.get(3, 1)), bool(spec.get(4, 1)), True)
    for text in ["ｶﾞ ﬁ  x", "  ½ ①　a\tb ", "é é ＡＢＣ", "plain", "", "한글 ㈱"]:
        normal, origin = own.normalize(text)
        assert normal == normalizer.normalize(text)
        assert len(origin) == len(normal) + 1 if normal else True
        assert all(a <= b for a, b in zip(origin, origin[1:]))
    normal, origin = own.normalize("xﬁy")
    data = "xﬁy".encode()
    at = normal.index("f")
    assert data[origin[at]:origin[at + 2]].decode() == "ﬁ" and origin[at + 1] == origin[at]


def test_encoding_table_edges(edge_docs, no_docs):
    got = pieces.encode_table(edge_docs, MODEL).collect()
    assert len(got) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["ids"] == by_id[2]["ids"] == by_id[10]["ids"] == [2]
    assert by_id[4]["ids"] == LIBRARY.encode("word " * 40000) + [2]
    digests = pieces.digest_table(edge_docs, MODEL).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in digests) == sorted((r["doc_id"] or -1, len(r["ids"])) for r in got)
    assert pieces.digest_table(no_docs, MODEL).collect() == []


# ---------------------------------------------------------------- rules

def test_rule_counts():
    assert host_rules.text_stats(None) == host_rules.text_stats("") == (0, 0, 0, 0, 0)
    assert host_rules.text_stats("a b c a b c x") == (7, 7, 0, 0, 6)
    assert host_rules.text_stats("a a a a") == (4, 4, 0, 0, 4)
    assert host_rules.text_stats("x\n\nx\n \n \n#|") == (3, 4, 2, 1, 0)


def test_rule_edges(spark, edge_docs, no_docs):
    got = host_rules.host_rules(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert all(r["kept"] <= (not r["base_failed"]) for r in got)
    assert host_rules.host_rules(no_docs).collect() == []
    kept = host_rules.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns and host_rules.keep_good(no_docs).collect() == []


def test_bad_host_takes_its_good_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "few words", "bad") for i in range(200)] + [(900, good, "bad"), (901, good, None), (902, good, "new")]
    rows += [(1000 + i, good, f"h{i % 5}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in host_rules.host_rules(docs).collect()}
    assert not kept[900] and kept[901] and kept[902] and kept[1000]


# ---------------------------------------------------------------- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header>
<nav><ul><li><a href=x>m1</a><li><a href=y>m2</a></ul></nav><div class="cookie-notice">We use cookies. Accept.</div>
<article><h1>Title &amp; more</h1><p>First <b>para
graph</b> of the story with many words.<br><p>Second &lt;one&gt; &#233;.</p><script>var t="</p>";</script>
<ul><li>item one<li>item two</ul><div class=ad>Buy now!</div></article>
<aside>Other</aside><form>Name <button>Go</button></form><section id="comments"><p>Nice!</p></section><footer>&copy; me</footer></body></html>"""


def test_page_text():
    model = main_text.Potentials.learn(main_text.page_counts(PAGE))
    assert main_text.extract(PAGE, model).split("\n") == [
        "Title & more", "First para graph of the story with many words.", "Second <one> é.", "item one", "item two"]
    for odd in (None, "", "<", "a < b", "<p", "<!-- x", "</p></div>", "<script>", "<p>" * 2000):
        main_text.extract(odd, model)


@pytest.mark.parametrize("seed", range(5))
def test_messages_give_the_exact_marginals(seed):
    rng = np.random.default_rng(seed)
    tags = ["div", "p", "nav", "article", "li"]
    blocks = [main_text.Block("html", -1, frozenset())]
    for i in range(1, 9):
        blocks.append(main_text.Block(tags[rng.integers(5)], int(rng.integers(i)), frozenset(), below=int(rng.integers(500))))
    model = main_text.Potentials.learn(main_text.page_counts(PAGE))
    seen, edges = main_text.observations(blocks), [main_text.edge(blocks, i) if i else 0 for i in range(9)]
    weight = np.zeros((9, 2))
    for labels in itertools.product((0, 1), repeat=9):
        log = sum(0.5 * model.unary.get(o, 0.0) for y, row in zip(labels, seen) if y for o in row)
        log += sum(model.pair[edges[i], labels[blocks[i].parent], labels[i]] for i in range(1, 9))
        for i, y in enumerate(labels):
            weight[i, y] += math.exp(log)
    assert np.allclose(model.marginals(blocks), weight[:, 1] / weight.sum(axis=1))


HALF = 500_000
HOSTILE = {
    "tags without an end": "<a " * (HALF // 3),
    "one quote at the end": "<a " * (HALF // 3) + '">',
    "names without an end": "<a" * (HALF // 2) + '/">',
    "both quotes": "<a \"'" * (HALF // 5) + ">",
    "buttons": "<button>" * (HALF // 8),
    "stray end tags": "<address>" * (HALF // 18) + "</div>" * (HALF // 12),
    "rows below no table": "<td><table>" + "<address>" * (HALF // 36) + "<tr>" * (HALF // 16),
    "lone signs": "<" * HALF + ">",
    "comments": "<!--" * (HALF // 4),
    "many zeros": "&#" + "0" * HALF + "65;",
    "no such character": "&#" + "9" * HALF + ";",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_page_work_is_linear(name):
    model = main_text.Potentials.learn({})
    start = time.process_time()
    main_text.extract(HOSTILE[name], model)
    assert time.process_time() - start < 10


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<>/!-?\"'= abp"), max_size=40))
def test_tags_are_found_as_by_trying_every_place(html):
    def end_of(at):
        quote = ""
        for i in range(at, len(html)):
            if quote:
                quote = "" if html[i] == quote else quote
            elif html[i] == ">":
                return i
            elif html[i] in "\"'":
                quote = html[i]
        return -1

    wanted, at = [], 0
    while at < len(html):
        begin, at = at, at + 1
        if html[begin] != "<":
            continue
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 4)
            at = end + 3 if end >= 0 else len(html)
            wanted.append((begin, at, "", "", ""))
        elif html[begin + 1:begin + 2] in ("!", "?"):
            end = html.find(">", begin)
            if end >= 0:
                at = end + 1
                wanted.append((begin, at, "", "", ""))
        else:
            slash = "/" if html[begin + 1:begin + 2] == "/" else ""
            first = begin + 1 + len(slash)
            stop = next((i for i in range(first, len(html)) if html[i] in " />"), len(html))
            if html[first:first + 1].isalpha() and (end := end_of(stop)) >= 0:
                at = end + 1
                wanted.append((begin, at, slash, html[first:stop], html[stop:end]))
    tags, found, at = main_text.Tags(html), [], 0
    while tag := tags.after(at):
        found.append(tag)
        at = tag[1]
    assert found == wanted


def test_character_references_of_any_length():
    assert main_text.characters("&amp;&#65;&#" + "0" * 5000 + "66;&#" + "9" * 5000 + ";!") == "&AB\ufffd!"


def test_page_table_edges(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, None), (None, "u", "", "t"), (3, "u", "<article><p>" + "long text " * 50000, "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = main_text.main_text(pages).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["n_chars"] for r in got}[3] == len("long text " * 50000) - 1
    assert main_text.main_text(pages.limit(0)).collect() == []
