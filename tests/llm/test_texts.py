"""Chat formatting, page extraction and sampled segmentations."""

import random

import numpy as np
from os.path import commonprefix

import pytest
from pyspark.sql import functions as F
from wxpipe.llm import page_diff, piece_sampling
from wxpipe.llm.chat_format import format_conversations, read_loss, read_turns

TURNS = "conv_id long, turn long, role string, text string, turns string"
ODD_TEXTS = ["\\### Assistant: </turn> ok", "<next>", "\\l\\b\\g <turn:user>", "", None, "a\nb </turn>\n", "\\"]


def _conversations():
    rng = random.Random(2)
    rows = []
    for conv in [*range(30), None]:
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "a>b", None]), rng.choice([*ODD_TEXTS, "plain text"]), "x"))
    rows += [(40, 1, "user", "tie b", "x"), (40, 1, "user", "tie a", "x"), (40, None, "user", "first", "x"), (40, 1, "user", "tie a", "x")]
    return rows


def test_chat_round_trip(spark):
    rows = _conversations()
    out = format_conversations(spark.createDataFrame(rows, TURNS)).select(
        "conv_id",
        "n_blocks",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    got = {r["conv_id"]: r for r in out.collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        mine = sorted(
            (r for r in rows if r[0] == conv),
            key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g")),
        )
        turns = [(r[2] or "", r[3] or "") for r in mine]
        assert [tuple(t) for t in row["turns"]] == turns
        assert row["loss"] == [t for role, t in turns if role == "assistant"]
        assert row["n_blocks"] == 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))


def test_chat_of_no_rows(spark):
    assert format_conversations(spark.createDataFrame([], TURNS)).count() == 0


PAGE = (
    "<html><head><title>T</title><style>p{}</style></head><body><nav><a>Home</a></nav>"
    '<div class="cookie-notice"><div>We use cookies</div>ok</div><aside>side</aside>'
    "<article><h1>Head&amp;line</h1><p>One <b>bo</b>ld&nbsp;word<br>two<p>three\n four"
    '<script>var t="</article>";</script><form><input>send</form><!-- <p>no</p> --></p>'
    '<section id="comments"><p>first!</p></section><div class="share">tweet</div></article>'
    '<div class="ad">buy</div><footer>&copy; me</footer></body></html>'
)


def test_article_without_its_surroundings():
    lines, marked = page_diff.parse(PAGE)
    assert marked
    assert " ".join(lines) == "Head&line One bold word two three four"


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &lt;text&gt; only", "plain <text> only"),
        ("<p>a<p>b", "a b"),
        ('<div class="ad">x<article>kept</article>', "kept"),
        ("<main><p>m</p><nav>n</nav></main><p>out</p>", "m"),
        ("<p title='a>b'>c</p><!-- open", "c"),
        ("<script>x", ""),
        ("a < b", "a < b"),
        ("<ul><li>one<li>two</ul>", "one two"),
    ],
)
def test_odd_pages(page, text):
    assert " ".join(page_diff.parse(page)[0]) == text


def _lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_places_are_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(25))] for _ in range(2))
        places = page_diff.common_places(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in places)
        assert len(places) == _lcs(a, b)


def test_pages_without_article_lose_what_neighbours_share(spark):
    shell = "<div>Top bar</div><div>{}</div><div>Bottom</div>"
    rows = [
        (1, "http://h/a/1", shell.format("first text")),
        (2, "http://h/a/2?x=1", shell.format("second text")),
        (3, "http://other/a/2", shell.format("alone")),
        (4, "http://h/b", None),
        (5, None, shell.format("no url")),
        (6, "http://copy/1", shell.format("twin")),
        (7, "http://copy/2", shell.format("twin")),
    ]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in page_diff.extract(pages).collect()}
    assert got == {
        1: "first text",
        2: "second text",
        3: "Top bar alone Bottom",
        4: "",
        5: "Top bar no url Bottom",
        6: "Top bar twin Bottom",
        7: "Top bar twin Bottom",
    }
    assert page_diff.extract(pages.limit(0)).count() == 0


def test_pages_with_article_are_compared_too(spark):
    shell = "<main><div>Top bar</div><article><p>{}</p><p>{}</p></article><div>{}</div></main><div>Foot</div>"
    rows = [
        # A teaser that both pages show is not the page's text alone.
        (1, "http://h/a/1", shell.format("teaser", "more", "first text")),
        (2, "http://h/a/2", shell.format("teaser", "more", "second text")),
        # A paragraph that both articles have is the article's.
        (3, "http://i/a/1", shell.format("same", "one", "note 1")),
        (4, "http://i/a/2", shell.format("same", "two", "note 2")),
        # Copies, and pages alone, keep their article.
        (5, "http://j/a", shell.format("same", "one", "note")),
        (5, "http://j/a", shell.format("same", "one", "note")),
        (6, "http://k/a", shell.format("same", "one", "note")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"]) for r in page_diff.extract(pages).collect())
    assert got == [
        (1, "teaser more first text"),
        (2, "teaser more second text"),
        (3, "same one"),
        (4, "same two"),
        (5, "same one"),
        (5, "same one"),
        (6, "same one"),
    ]


@pytest.mark.parametrize("parts", [1, 3, 8, 40])
def test_texts_do_not_depend_on_the_ranges(spark, parts):
    """Pages of one host, of several, and alone in their range."""
    shell = "<div>Top bar</div><div>text {}</div><div>Foot {}</div>"
    rows = [(n, f"http://h{n // 9}/a/{n:03d}", shell.format(n, n // 2)) for n in range(30)]
    rows += [(90, "http://z/1", shell.format(90, 1)), (91, "http://h0/a/004", "<article>own</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = page_diff.extract(pages)
        got = {r["page_id"]: r["text"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Neighbours in order of host, path and id; paths alike, so the one before counts.
    parsed = {n: page_diff.parse(html) for n, _, html in rows}
    order = sorted(rows, key=lambda r: (r[1].split("/")[2], r[1], r[0]))
    order = [r for r in order if not parsed[r[0]][1]]
    expected = {91: "own"}
    for i, (n, url, _) in enumerate(order):
        host, path = url.split("/")[2], "/" + url.split("/", 3)[3]
        near = [
            (len(commonprefix(("/" + u.split("/", 3)[3], path))), j < i, m)
            for j, (m, u, _) in enumerate(order)
            if abs(j - i) == 1 and u.split("/")[2] == host
        ]
        lines = parsed[n][0]
        if near:
            best = max(near)
            lines = page_diff.without_shared(lines, parsed[best[2]][0])
        expected[n] = " ".join(lines)
    assert got == expected
    assert got[91] == "own" and "Top" not in got[8] and "Top" in got[90]


def _segmentations(text, vocab):
    known = {vocab.bytes[i]: i for t in vocab.tables for i in t.ids[t.ids >= 0].tolist()}
    data = (" " + text).encode()

    def walk(at):
        if at == len(data):
            yield (), 0.0
        for end in range(at + 1, len(data) + 1):
            if (piece := known.get(data[at:end])) is not None:
                for rest, weight in walk(end):
                    yield (piece, *rest), weight + vocab.weight[piece]

    return dict(walk(0))


def test_samples_follow_the_law_of_drawing_without_replacement():
    vocab = piece_sampling.vocabulary(piece_sampling.MODEL, 0.3)
    weights = _segmentations("that", vocab)
    logs = np.array(list(weights.values()))
    chance = np.exp(logs - np.logaddexp.reduce(logs))
    place = {ids: n for n, ids in enumerate(weights)}
    runs, first, second = 8000, np.zeros(len(place)), np.zeros(len(place))
    seeds = piece_sampling._mixed(np.arange(runs).astype(np.uint64))
    for found in piece_sampling.sample_texts(["that"] * runs, seeds, vocab, 2):
        first[place[tuple(found[0][0].tolist())]] += 1
        second[place[tuple(found[1][0].tolist())]] += 1
    expected = [sum(chance[j] * chance[i] / (1 - chance[j]) for j in range(len(chance)) if j != i) for i in range(len(chance))]
    assert np.abs(first / runs - chance).max() < 0.02
    assert np.abs(second / runs - np.array(expected)).max() < 0.02


def test_all_segmentations_when_there_are_few():
    vocab = piece_sampling.vocabulary(piece_sampling.MODEL, 0.8)
    count = len(_segmentations("at", vocab))
    found = piece_sampling.sample_texts(["at"], np.array([9], np.uint64), vocab, count + 3)[0]
    assert len({tuple(ids.tolist()) for ids, *_ in found}) == len(found) == count
    assert all(x[3] == 1.0 for x in found)
    assert sum(np.exp(x[1]) for x in found) == pytest.approx(1.0)
    assert [x[2] for x in found] == sorted((x[2] for x in found), reverse=True)


def test_sampled_ids_decode_to_the_text(spark):
    texts = [None, "", "a", "The  end \n\n", "▁ ▁x", "\U0001f600é中" * 40, "x" * 5000, "tab\tand nul\x00", "w " * 500]
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)] + [(None, "nameless", "k", 1), (2, "a", "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, sample int")
    encoded = piece_sampling.sample_pieces(docs)
    out = encoded.collect()
    assert all(r["round_trip"] for r in out)
    decoded = piece_sampling.decode_pieces(encoded).collect()
    assert {(r["doc_id"], r["text"]) for r in decoded} == {(i, t or "") for i, t, *_ in rows}
    alone = piece_sampling.sample_pieces(docs.where("doc_id = 8")).collect()
    assert [r for r in out if r["doc_id"] == 8] == alone
    assert encoded.where("doc_id = 8").select("ids").distinct().count() == 2
    assert piece_sampling.sample_pieces(docs.limit(0)).count() == 0


def test_variates_are_drawn_for_all_texts_at_once(monkeypatch):
    """The same stretches in more texts: as many steps, each over more rows."""
    vocab = piece_sampling.vocabulary(piece_sampling.MODEL, piece_sampling.ALPHA)
    mixed, calls = piece_sampling._mixed, []
    monkeypatch.setattr(piece_sampling, "_mixed", lambda x: calls.append(len(x)) or mixed(x))

    def drawn(texts):
        calls.clear()
        found = piece_sampling.sample_texts(texts, np.arange(len(texts), dtype=np.uint64) * np.uint64(0), vocab, 3)
        return len(calls), found

    few, one = drawn(["some words of a text"])
    many, all_found = drawn(["some words of a text", ""] * 50)
    assert many == few
    for found in all_found[::2]:
        assert [(ids.tolist(), *rest) for ids, *rest in found] == [(ids.tolist(), *rest) for ids, *rest in one[0]]
    assert all(len(found) == 1 and not len(found[0][0]) for found in all_found[1::2])
