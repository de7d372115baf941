import hashlib
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm import chat, html_text, packing
from starmart.llm.token_counts import ChunkMap, Counter, Transducer, count_tokens, scan


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.SentencePieceProcessor(model_file=file), Counter(file)


def test_transducer_equals_merging():
    rng = random.Random(3)
    tried = 0
    for _ in range(80):
        vocabulary = {c: -1000.0 for c in "abc"}
        for i in range(12):
            vocabulary.setdefault(rng.choice(list(vocabulary)) + rng.choice(list(vocabulary)), -float(i))
        machine = Transducer(vocabulary)
        try:
            for piece in range(len(vocabulary)):
                machine.made(piece)
        except ValueError:
            continue
        tried += 1
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
            assert machine.count(word) == len(machine.merge(list(word))[0])
    assert tried > 20


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet="abcdeT  \n\t.,▁éß漢😀<s>01\x00'", max_size=50), chunk=st.sampled_from([1, 3, 10, 1000]))
def test_token_counts_equal_the_library(pieces, text, chunk):
    library, counter = pieces
    assert counter.text(text, chunk) == len(library.encode(text))


def test_maps_compose_in_any_grouping(pieces):
    counter = pieces[1]
    text = "▁the▁▁quick\nbrown▁fo" * 5
    maps = [counter.chunk(text[i:i + 4]) for i in range(0, len(text), 4)]
    left = ChunkMap()
    for m in maps:
        left = left.then(m, counter)
    assert counter.whole(left) == counter.whole(scan(maps, counter)) == counter.whole(counter.chunk(text))


def test_count_tokens_edge_rows(spark, edge_docs, no_docs, pieces):
    got = sorted(map(tuple, count_tokens(edge_docs, limit=100).collect()), key=str)
    want = sorted(((r.doc_id, len((r.text or "").encode()), n := len(pieces[0].encode(r.text or "")), n > 100) for r in edge_docs.collect()), key=str)
    assert got == want
    assert count_tokens(no_docs).count() == 0


def brute_cost(places, fees, capacity):
    best = [0] + [10**9] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= capacity:
                best[j] = min(best[j], best[i] + capacity - (places[j] - places[i]) + fees[j])
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(5)
    for _ in range(200):
        gaps = [rng.randint(1, 9) for _ in range(rng.randint(1, 30))]
        places = np.cumsum([0, *gaps])
        fees = np.array([rng.choice([0, 2, 5]) for _ in places])
        cuts = packing.best_cuts(places, fees, 12)
        assert cuts[0] == 0 and cuts[-1] == places[-1]
        fee = dict(zip(places.tolist(), fees.tolist(), strict=True))
        cost = sum(12 - (b - a) + fee[b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        assert all(b - a <= 12 for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        assert cost == brute_cost(places.tolist(), fees.tolist(), 12)


@pytest.mark.parametrize("planned", [50, 1 << 20])
def test_packing_round_trip(spark, edge_docs, no_docs, planned):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(edge_docs.coalesce(2), 64, planned=planned).collect()
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == r.length > 0 and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    # rows that share an id have the same text here, but for the NULL ids
    have = sorted((r.doc_id or -1, r.start, tuple(r.ids)) for r in rows if r.doc_id is not None)
    tokens = {}
    for d, start, ids in have:
        tokens.setdefault(d, {}).setdefault(start, []).append(ids)
    for r in edge_docs.where("doc_id is not null and doc_id <> 2").collect():
        ids = [i for s in sorted(tokens[r.doc_id]) for i in tokens[r.doc_id][s][0]]
        assert ids == [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
    want = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in edge_docs.collect())
    assert sum(r.length for r in rows) == want
    assert packing.pack(no_docs).count() == 0


def test_little_padding():
    rng = np.random.default_rng(2)
    ends = np.zeros(100, bool)
    ends[7] = True
    packer, total = packing.Packer(4096, ends), 0
    pieces = []
    for d in range(400):
        ids = rng.integers(0, 100, rng.integers(1, 3000)).astype(np.uint16)
        total += len(ids)
        pieces += packer.add(d, ids)
    pieces += packer.finish()
    assert sum(p[2] for p in pieces) == total and packer.sequence * 4096 < 1.02 * total + 4096


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=40), max_size=30), st.integers(1, 200), st.integers(5, 30))
def test_cuts_do_not_depend_on_when_they_are_given_out(documents, planned, capacity):
    ends = np.zeros(10, bool)
    ends[[0, 1]] = True

    def pieces(size):
        packer = packing.Packer(capacity, ends, size)
        out = [p for i, d in enumerate(documents) for p in packer.add(i, np.array(d, np.uint16))] + packer.finish()
        return [(p[0], p[1], p[2], p[3].tolist(), *p[4:]) for p in out]

    whole = pieces(1 << 40)
    assert pieces(planned) == whole
    assert [i for p in whole for i in p[3]] == [i for d in documents for i in d]


def test_settled_windows_leave_memory():
    rng, ends = np.random.default_rng(3), np.zeros(100, bool)
    packer, most = packing.Packer(4096, ends, 1 << 16), 0
    for d in range(8000):
        packer.add(d, rng.integers(0, 100, rng.integers(1, 800)).astype(np.uint16))
        most = max(most, sum(len(x[1]) for x in packer.documents))
    assert most < packer.length / 3


@pytest.mark.parametrize("seed", range(4))
def test_token_ids_against_the_library(seed):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoder, rng = packing.Encoder(public_tokenizers.path("word_bpe_49k.json")), random.Random(seed)
    letters = "aZéÉßİıǅµªº²½×÷ÿŸĲſ'sStTllLLd.,!?-0 1\t\n\u00a0\u0085\u00ad\u1680漢字😀e\u0301\u0345\x00\x1c|<>" + "abcdefgh" * 3
    texts = ["".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(1500)]
    texts += [f"a{chr(code)}b {chr(code)}{chr(code)} {chr(code)}'s" for code in [*range(0x250), 0x1E9E, 0x2160]]
    texts += ["", " ", "a <|endoftext|> b<|startoftext|>", "x\x1cy <|end"]
    for text, ids in zip(texts, encoder.texts(pa.array(texts), 2), strict=True):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], repr(text)


TEXT = st.lists(st.sampled_from(["<", "|", "\\", "im_end|>", chat.END, chat.START, "\n", "a", "<\\|", "é"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(["user", "\\", "\n", "n", "<|", chat.START, chat.END]), max_size=3).map("".join), TEXT), max_size=4), st.integers(1, 7))
def test_chat_round_trip(turns, step):
    written = "".join(chat.render(*t)[0] for t in turns)
    assert [(t.role, t.text) for t in chat.read(written)] == turns
    assert written.count(chat.START) == len(turns) == written.count(chat.END)
    parser, found = chat.Parser(), []
    for i in range(0, len(written), step):
        found += parser.feed(written[i:i + step])
    parser.close()
    assert [(t.role, t.text) for t in found] == turns
    assert all(chat.unescape(written[t.low:t.high]) == t.text for t in found)


def test_chat_rejects_broken_text():
    for text in ("x", chat.START + "user\nhi", chat.START + "user\nhi" + chat.END, chat.START + "u\na" + chat.START + "b" + chat.END + "\n"):
        with pytest.raises(ValueError):
            chat.read(text)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (None, 0, None, "x" * 100_000), (2, None, "assistant", ""), (2, 0, "user", chat.END),
            (3, 0, f"a{chat.START}\\{chat.END}", chat.START)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as rendered")
    got = {r.conv_id: r for r in chat.summarize(chat.format_turns(df)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == digest("user\n\nassistant\nb\nassistant\nb\n") and got[1].loss_sha256 == digest("bb") and got[1].loss_chars == 2
    assert got[2].turns_sha256 == digest(f"assistant\n\nuser\n{chat.END}\n") and got[2].formatted_chars == len(chat.render("assistant", "")[0] + chat.render("user", chat.END)[0])
    assert got[None].n_turns == 1 and len(got) == 4 and got[3].formatted_chars == len(chat.render(*rows[-1][2:])[0])
    assert chat.summarize(chat.format_turns(df.limit(0))).count() == 0


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b  c<br>d", "a\nb c d"), ("<script>var a='<p>no</p>'", ""),
    ("<nav>Menu</nav><article><h1>T</h1><p>one <b>two</b></p><div class='ad'>buy</div><p>.</p></article><footer>f</footer>", "T\none two\n."),
    ("<div class=cookie-notice>ok?</div><div><p>Some long text stands here.</p><p>And more of it.</p></div><div id=comments><p>first!</p></div>",
     "Some long text stands here.\nAnd more of it."),
    ("<ul><li><a href=a>One</a><li><a href=b>Two</a></ul><p>A text that is long.</p>", "A text that is long."),
    ("<nav><ul><li>never closed<article><p>kept</p></article>", "kept"), ("<!-- <p>x</p> --><p title='>'>y</p", "y"), ("a < b", "a < b"),
    ("<form><p>name</p></form><aside>side</aside><header>head</header><main><header>own</header><p>body</p></main>", "own\nbody"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_page_rows(spark):
    rows = [(1, "u", "<p>" + "long text " * 100_000), (1, "u", None), (None, None, "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "0 as n_chars")
    assert sorted((r.page_id or 0, r.n_chars) for r in html_text.extract(df).collect()) == [(0, 1), (1, 0), (1, 999_999)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_wanted_text_is_not_lost_for_being_short():
    long = "A sentence of the article that goes on for a while. " * 20
    inside = html_text.main_text(f"<body><main><h1>Title</h1><article>{long}</article><div class=ad>buy</div><article>Short.</article></main><p>foot</p></body>")
    assert inside.split("\n") == ["Title", long.strip(), "Short."]
    plain = html_text.main_text(f"<body><div id=text><p>{long}</p><div class=advert><p>buy now</p></div><p>The end.</p></div><footer>x</footer></body>")
    assert plain.split("\n") == [long.strip(), "The end."]
    other = html_text.main_text(f"<body><div id=text><p>{long}</p></div><div class=advert>buy</div><div>About us</div></body>")
    assert other == long.strip()


SENTENCE = "A sentence of the article that goes on for a while. " * 8


@pytest.mark.parametrize("page, text", [
    # comments and teasers are articles as well, but part of what holds them
    ("<article><h1>T</h1><p>@</p></article><section id=comments><article class=comment><p>first</p></article></section>", "T\n@"),
    ("<article><p>@</p></article><aside class=related><article class=teaser><h3><a>x</a></h3><p>t</p></article></aside>", "@"),
    ("<article><p>@</p><ol class='comment-list'><li><article><p>hi</p></article></li></ol></article>", "@"),
    ("<div id=page><div class=ad>buy<article><p>@</p></article></div>", "@"),  # one of the two was never closed
    # a name that only holds an unwanted word decides nothing
    ("<article><p>@</p><p class=ad-hoc>Ad hoc.</p><p class=ad-free>Free.</p><section id=social-policy><p>Policy.</p></section></article>",
     "@\nAd hoc.\nFree.\nPolicy."),
    ("<body class=no-sidebar><div id=page class=with-sidebar><ul><li><a>" + "m" * 900 + "</a></ul><div><p>@</p></div></div></body>", "@"),
    ("<article><p>@</p><div class='social-extra'><a>Share it</a></div></article>", "@"),
    ("<article><div class=header><h1>T</h1></div><p>@</p></article>", "T\n@"),
    # surge and dive of marked content
    ("<article><ul><li><a>1</a><li><a>2</a><li><a>3</a></ul><h1><a>T</a></h1><p>@</p><ul><li><a>4</a><li><a>5</a><li><a>6</a></ul></article>", "T\n@"),
    ("<main><article><p>@</p><ul><li><a>1</a><li><a>2</a></ul><p>.</p></article><article><a>Another</a></article></main>", "@\n1\n2\n."),
    ("<article><a>only</a></article>", "only"),
    # a short end in the container of the text, behind a menu
    ("<body><div id=text><p>@</p><nav>x</nav><p>End.</p></div><nav>y</nav><div>About us</div></body>", "@\nEnd."),
    # paragraphs and list items need no closing tag
    ("<article><p class=ad>buy<p>@</article>", "@"), ("<article><ul><li class=ad>buy<li>@</ul></article>", "@"),
])
def test_line_blocks_and_names(page, text):
    long = SENTENCE.strip()
    assert html_text.main_text(page.replace("@", long)) == text.replace("@", long)


def test_generated_pages_give_back_their_article():
    """Pages are put together from an article's lines and from what does not belong, which may stand in between."""
    rng = random.Random(5)
    foreign = [
        "<nav><a href=x>Home</a><a href=y>News</a></nav>", "<div class='ad-slot'><p>Buy this.</p></div>", "<script>if (a < b) '<p>no</p>'</script>",
        "<aside><h4>Also</h4><article><p>A teaser of some other story.</p></article></aside>", "<form><p>Your name</p><input name=n></form>",
        "<div id='cookie-notice'>We use cookies on this site.</div>", "<!-- <p>gone</p> -->", "<style>p{}</style>",
        "<section class='comments-area'><article class='comment odd'><p>I read this twice.</p></article></section>",
        "<div class='share-buttons'><a>One</a><a>Two</a></div>", "<svg><text>x</text></svg>", "<p class=advertisement>Buy that.</p>",
    ]
    wanted = ["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<div>{}</div>", "<p class=ad-hoc>{}</p>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>",
              "<p>{} </p>\n\n", "<div class='no-comments'><p>{}</p></div>", "<table><tr><td>{}</td></tr></table>"]
    words = "sun rain &amp; wind caf&eacute; 5&lt;7 über naïve text of a long line".split()
    for _ in range(400):
        lines = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(rng.randint(1, 12))]
        body = ""
        for line in lines:
            body += rng.choice(wanted).format(line.replace(" ", " <b>and</b> ", 1) if rng.random() < 0.3 else line)
            body += rng.choice(foreign) if rng.random() < 0.3 else ""
        mark = rng.choice(["article", "main"])
        page = "".join(rng.choices(foreign, k=2)) + f"<{mark}>{body}</{mark}>" + "".join(rng.choices(foreign, k=3)) + "<footer>&copy; us</footer>"
        want = html_text.html.unescape("\n".join(lines))
        assert html_text.main_text(f"<html><body class='has-sidebar'>{page}</body></html>").replace(" and ", " ") == want


def test_time_grows_with_the_page_only():
    for part in ("<div class='x-ad'>", "<nav>", "<p class=ad>", "<li><ul>", "<a class=social-x>", "<article>", "<div>x", "</div>", "<nav>a</nav>"):
        start = time.perf_counter()
        html_text.main_text(part * 20_000 + "</td>" * 20_000)
        assert time.perf_counter() - start < 5
