"""Operators on single texts against brute force: pieces, fingerprints, extraction, decontamination, classifiers."""

import hashlib
import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, extract, fingerprint, pieces, quality, toxicity
from tablewright.llm.common import Powers
from tablewright.llm.queries import TOKENIZER

EDGE = [None, "", " ", "a", "  two  ▁ x\n\ty漢字", "x" * 3000, "a b " * 200, "▁▁", "\U0001f642 ok", "ñé " * 300]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(TOKENIZER)


def best_score(v, text):
    """Full dynamic programme over one text, without window or commits."""
    chars = [pieces.MARK] * bool(text) + [pieces.LITERAL if ord(c) == pieces.MARK else pieces.MARK if c == " " else ord(c) for c in text]
    word = "".join(map(pieces._char, chars))
    best = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - v.longest), end):
            piece = v.known.get(word[start:end])
            score = v.scores[piece] if piece is not None else v.fallback if end - start == 1 else None
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_pieces_are_the_best_segmentation_and_round_trip(spark, vocabulary):
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(EDGE)], "doc_id long, text string, exact string")
    rows = {r.doc_id: r for r in pieces.encode(df, vocabulary).collect()}
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df, vocabulary), vocabulary).collect()}
    for i, text in enumerate(EDGE):
        assert rows[i].exact and back[i] == text
        if text is None:
            assert rows[i].ids is None and rows[i].n_tokens == 0
            continue
        assert rows[i].n_tokens == len(rows[i].ids)
        spelled = [k for k in rows[i].ids if k in set(vocabulary.byte_ids.tolist())]
        score = sum(vocabulary.scores[k] for k in rows[i].ids if k not in set(spelled))
        lost = sum(1 for c in text if c == "▁" or (pieces.MARK if c == " " else ord(c)) and (c if c != " " else "▁") not in vocabulary.known)
        assert score + lost * vocabulary.fallback == pytest.approx(best_score(vocabulary, text))


def test_stream_commits_early_and_agrees(vocabulary):
    text = "ab" * 2000 + " " + "é" * 500
    chars = [pieces.MARK] + [pieces.MARK if c == " " else ord(c) for c in text]
    stream = pieces.Stream(vocabulary)
    out = []
    for i in range(0, len(chars), 7):
        out += stream.feed(chars[i : i + 7])
        assert len(stream.text) < 50 * vocabulary.longest
    ids, _ = pieces.Encoder(vocabulary).encode(pa.array([text]))
    assert out + stream.finish() == ids.tolist()


def test_encoder_memory_and_forgotten_words(vocabulary, monkeypatch):
    words = [f"w{i * 7919 % 100_003}" for i in range(400_000)]
    texts = pa.array([" ".join(words[i : i + 200]) for i in range(0, len(words), 200)])
    whole = pa.RecordBatch.from_arrays([texts], names=["text"])

    def run(limit):
        encoder = pieces.Encoder(vocabulary)
        return np.concatenate([encoder.encode(part.column(0))[0] for part in pieces.chunks([whole], 0, limit)])

    tracemalloc.start()
    ids = run(pieces.CHUNK)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 140 << 20
    # Smaller steps, and a memory that starts anew many times, give the same ids.
    monkeypatch.setattr(pieces, "REMEMBERED", 5_000)
    assert np.array_equal(run(1 << 15), ids)


def test_fingerprints(spark):
    source = random.Random(3)
    words = lambda n: " ".join("".join(source.choices("abcdefgh", k=5)) for _ in range(n))
    texts = [(i, words(300)) for i in range(40)] + [(40, None), (41, ""), (42, "x" * 5000), (43, "abcd " * 3000), (7, "twice"), (None, words(50)), (45, words(20000))]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in texts], "doc_id long, text string, part double").repartition(5)
    rows = sorted(fingerprint.fingerprints(df).collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    assert len(rows) == len(texts)
    known = [(i, t or "") for i, t in sorted(texts, key=lambda x: -(x[0] or -1)) if i != 7]
    by_id = {r.doc_id: r for r in rows}
    for (i, text), (_, after) in zip(known, known[1:] + known[:1]):
        row = by_id[i]
        assert row.n_chars == len(text)
        if i not in (8, 6):  # the neighbours of the repeated id
            cut = len(text) // 3
            changed = text[: len(text) - cut] + after[:cut]
            assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
            assert row.edited_fingerprint == fingerprint.fingerprint(changed.encode(), Powers())
        assert row.fingerprint == fingerprint.fingerprint(text.encode(), Powers())
    long = [r for r in rows if r.n_chars > 1000 and r.doc_id not in (42, 43)]
    assert all(r.near_edited > 0.4 and r.near_next < 0.4 for r in long)
    assert fingerprint.fingerprints(df.limit(0)).count() == 0


def test_likeness_is_the_edit_distance():
    source = random.Random(1)
    for _ in range(50):
        a, b = (["".join(source.choices("AB", k=2)) for _ in range(source.randrange(30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert fingerprint._common(a, b) == table[-1][-1]


def chunks(raw, k):
    """How many chunks there are at block size 2^k, a window at a time."""
    ends = len(raw) * [False]
    for i in range(len(raw)):
        window = bytes(fingerprint.WINDOW - 1) + raw[: i + 1]
        known = [x + 1 for x in window[-min(i + 1, fingerprint.WINDOW) :]]
        rolling = sum(x * pow(0x100000001B3, fingerprint.WINDOW - j, 1 << 64) for j, x in enumerate(reversed(known))) % (1 << 64)
        ends[i] = int(fingerprint.mix(np.array([rolling], np.uint64))[0]) % (1 << k) == 0 or i == len(raw) - 1
    return sum(ends)


def test_every_chunk_of_a_repetitive_text_counts():
    """Signatures are whole, and so is the edit distance, where a text repeats a word or a line."""
    source = random.Random(6)
    some = lambda n: "".join(source.choices("abcdefgh ", k=n))
    powers = Powers()
    whole = lambda text: fingerprint.fingerprint(text.encode(), powers)
    # Of many words, the one with the most chunks.
    word = max((some(6) for _ in range(300)), key=lambda w: len(whole(w * 400)))
    texts = [word * 400, word * 300 + some(600), some(600) + word * 300, word * 200 + some(400) + word * 100, some(2400)]
    prints = [whole(t) for t in texts]
    for text, one in zip(texts, prints):
        k, fine, coarse = one.split(":")
        assert len(fine) == 2 * chunks(text.encode(), int(k)) and len(coarse) == 2 * chunks(text.encode(), int(k) + 1)
    assert all(len(p) > 4 * 200 for p in prints[:4])
    for x in prints:
        for y in prints:
            best = float(x == y)
            sides = [dict(enumerate(p.split(":")[1:], int(p.split(":")[0]))) for p in (x, y)]
            for k in sides[0].keys() & sides[1].keys():
                a, b = (np.array([s[k][i : i + 2] for i in range(0, len(s[k]), 2)]) for s in sides)
                row = np.zeros(len(b) + 1, int)
                for c in a:
                    row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == c)))
                best = max(best, 2 * row[-1] / (len(a) + len(b)))
            assert fingerprint.likeness(x, y) == best


PAGE = """<html><head><title>T</title></head><body><div id="cookie-notice">We use cookies on this site to give you the best of it.</div>
<header><h1>Site</h1></header><div class="sidebar"><p>The latest of the news and of the weather in the town is here.</p></div>
<div class="post"><h2>My headline</h2><p>This is the first paragraph of the article and it is long enough to be taken as the good text of the page, with many of the stop words in it.</p>
<p>Short one.</p><p>And the second   paragraph &amp; it is a long one, too, with a <a href=x>link</a> in the text and the other words of the language that it is in.</p></div>
<ul class=menu><li><a href=a>One</a><li><a href=b>Two</a></ul><div class="comments"><p>I think that the article is wrong and that the author is to be told of it by the readers.</p></div>
<form><p>Subscribe to the list of the site and get all of the news</p></form><script>if (a<b) document.write("</p>x")</script><footer>(c) the site of the town</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "<p" * 5000), (5, "u", "<article><p>" + "word " * 30000 + "</article>")]
    out = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in out}
    assert len(out) == 6 and all(r.n_chars == len(r.text) for r in out)
    lines = text[1].split("\n")
    assert lines[0] == "My headline" and lines[2] == "Short one." and len(lines) == 4
    assert lines[3].startswith("And the second paragraph & it is")
    assert text[2] == text[3] == "" and len(text[5]) == 5 * 30000 - 1


def plain_labels(found, first):
    """The second pass, by its definition: every open block looks for its neighbours itself."""
    marked = any(b.article and f == "good" for b, f in zip(found, first))
    counts = [i for i, (b, f) in enumerate(zip(found, first)) if f != "open" and not b.outside and b.tag not in ("title", "head")]
    labels = []
    for i, (b, f) in enumerate(zip(found, first)):
        if f != "open":
            labels.append(f)
            continue
        near = [max((j for j in counts if j < i), default=None), min((j for j in counts if j > i), default=None)]
        near = [j for j in near if j is not None]
        kinds = {first[j] for j in near}
        if b.doubt and b.tag not in extract.HEADINGS or marked and not b.article:
            good = False
        elif not near:
            good = b.article or b.tag in extract.PROSE
        elif marked:
            good = len(near) < 2 or kinds != {"bad"}
        else:
            closest = min(abs(j - i) for j in near)
            good = len(kinds) == 1 and kinds == {"good"} or len(kinds) == 2 and any(first[j] == "good" for j in near if abs(j - i) == closest)
        labels.append("good" if good else "bad")
    return labels


def test_second_pass_equals_a_plain_version():
    source = random.Random(3)
    for _ in range(3000):
        found, first = [], []
        for _ in range(source.randrange(12)):
            outside = source.random() < 0.2
            found.append(extract.Block("x", source.choice(["p", "h1", "div", "title"]), 0, outside, source.random() < 0.2, source.random() < 0.4))
            first.append("bad" if outside or found[-1].tag == "title" else source.choice(["good", "bad", "open", "open"]))
        assert extract.second_pass(found, first) == plain_labels(found, first)


def test_density_decides_and_a_tag_is_evidence(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    renamed = pages.withColumn("html", F.regexp_replace("html", "(</?)article", "$1div"))
    texts = {r.page_id: r.text.split("\n") for r in extract.extract(pages).collect()}
    same = total = 0
    for r in extract.extract(renamed).collect():
        total += len(texts[r.page_id])
        same += (Counter(texts[r.page_id]) & Counter(r.text.split("\n"))).total()
    assert same >= 0.95 * total
    teaser = "<p>It was the best of the news in the town and it is for all of you.</p>"
    story = "<p>" + "This is the story of the man and of the dog that was with him in the house on the hill, as it is told by them. " * 3 + "</p>"
    page = f"<nav><a href=x>Home</a></nav><article class=teaser>{teaser}</article><div class='post-header'><h1>Headline</h1></div><div>{story}<p>End.</p></div>"
    lines = extract.main_text(page).split("\n")
    assert lines[0] == "Headline" and lines[1].startswith("This is the story") and lines[2:] == ["End."]
    prose = extract.main_text(f"<article>{story}<p><a href=x>Read more</a></p><p>Ok.</p></article><div>Some words</div>")
    assert prose.endswith("by them.\nOk.")
    assert extract.main_text("<p title=it's>One &amp; <!-- <p>no --> two<script>'</p>'</script> three</p><p hidden>x</p>") == "One & two three"


@pytest.mark.parametrize("page", [
    "<a " * 33_000 + '"', "<div><b>" * 6_000 + "</i></p></b>" * 4_000, "<a =" + " " * 50_000 + "<a = " * 10_000, "<!--" * 25_000, "<script>" * 12_000,
    "<" * 100_000, "<b><div>" * 6_000 + "</b>" * 12_000, '<a class="' + "A-" * 50_000 + '">', "<a class" * 12_000 + '="', "<i>" * 16_000 + "<div></i>" * 5_000,
])
def test_hostile_pages_take_linear_time(page):
    start = time.perf_counter()
    extract.main_text(page)
    assert time.perf_counter() - start < 1


def test_decontamination_finds_every_item(spark):
    source = random.Random(5)
    words = ["".join(source.choices("abcdefghijklm", k=source.randrange(2, 9))) for _ in range(800)]
    say = lambda n: " ".join(source.choices(words, weights=[1 / (i + 1) for i in range(800)], k=n))
    items = [(i, f"{say(12)}. {say(8)}.") for i in range(150)] + [(150, None), (151, ""), (152, "one")]
    docs, planted = [], set()
    for d in range(200):
        text = say(150)
        if d % 3 == 0:
            text += "\n" + items[d % 150][1].upper() + " " + say(70)
            planted.add((d, d % 150))
        docs.append((d, text, "x"))
    docs += [(200, None, "x"), (201, "", "x"), (None, say(10), "x")]
    documents, benchmark = spark.createDataFrame(docs, "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(documents, benchmark).collect()}
    assert planted <= found and all(i == 152 for _, i in found - planted)
    assert decontaminate.matches(documents, benchmark.limit(0)).count() == 0
    kept = {r.doc_id for r in decontaminate.clean(documents, benchmark.where("item_id < 150")).collect()}
    assert kept == {None, 200, 201, *range(200)} - {d for d, _ in planted}


def test_blocks_and_bounds_lose_no_match():
    source = random.Random(9)
    items = [(i, " ".join(source.choices("abcdefghijklmnopqrstuvwxyz", k=12)), " ".join(source.choices("abcdefghij", k=4))) for i in range(200)]
    index = decontaminate.build_index(items)
    text = " ".join(source.choices("abcdefghijklmnopqrstuvwxyz", k=600))
    from tablewright.llm.common import text_bytes, word_hashes

    words, first = word_hashes(*text_bytes(pa.array([text])), Powers())
    got = {(b, i): s for b, _, _, i, s in zip(*(x.tolist() for x in decontaminate.retrieve(index, words, first)))}
    step = index.window // 2
    for begin in range(0, max(1, -(-600 // step) - 1) * step, step):
        terms = np.searchsorted(index.terms, np.unique(words[begin : begin + 2 * step]))
        score = np.zeros(len(index.items))
        for t in terms:
            span = slice(index.post_at[t], index.post_at[t + 1])
            score[index.post_item[span]] += index.post_impact[span]
        for i in np.flatnonzero(np.abs(score - decontaminate.THRESHOLD) > 1e-6):
            assert ((begin, i) in got) == (score[i] >= decontaminate.THRESHOLD)


def test_marginals_against_all_tag_sequences():
    source = np.random.default_rng(2)
    score, heads = source.normal(size=8), np.array([0, 5])
    moves, start = source.normal(size=(2, 2)), source.normal(size=2)
    toxic, _ = toxicity.marginals(score, heads, moves, start)
    for a, b in ((0, 5), (5, 8)):
        total, each = 0.0, np.zeros(b - a)
        for mask in range(1 << (b - a)):
            tags = [(mask >> i) & 1 for i in range(b - a)]
            s = start[tags[0]] + sum(score[a + i] * t for i, t in enumerate(tags)) + sum(moves[x, y] for x, y in zip(tags, tags[1:]))
            total += np.exp(s)
            each += np.exp(s) * np.array(tags)
        assert np.allclose(toxic[a:b], each / total)


@pytest.fixture(scope="module")
def labelled(spark):
    source = random.Random(4)
    calm, rude = ["".join(source.choices("aeioklmn", k=5)) for _ in range(300)], ["brute", "fool", "crook"]
    rows = []
    for i in range(900):
        words = source.choices(calm, k=source.randrange(20, 80))
        toxic, good = i % 7 == 0, i % 4 != 1
        for _ in range(3 * toxic):
            words.insert(source.randrange(len(words)), source.choice(rude) + source.choice(["", "!", ","]))
        text = " ".join(words) if good else " ".join(w + "$$%%" for w in words)
        rows.append((i, text, int(toxic), int(good)))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (None, "fool", "x")], "doc_id long, text string, score string")
    return docs, spark.createDataFrame([(i, t, q) for i, _, t, q in rows], "doc_id long, toxic int, quality int"), rows


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_rows_not_learnt(labelled, module, label):
    docs, labels, rows = labelled
    model = module.fit(docs, labels.where("doc_id % 3 <> 0"))
    scored = module.score(docs, model).collect()
    assert len(scored) == 903 and all(0 <= r.score <= 1 for r in scored)
    score = {r.doc_id: r.score for r in scored}
    held = [(score[i], t if label == "toxic" else q) for i, _, t, q in rows if i % 3 == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95


def test_toxic_spans_are_the_words(labelled):
    docs, labels, rows = labelled
    model = toxicity.fit(docs, labels)
    spans = {r.doc_id: r.spans for r in toxicity.score(docs, model).collect()}
    text = {i: t for i, t, _, _ in rows}
    found = [text[i][s.first : s.stop] for i in range(0, 900, 7) for s in spans[i]]
    assert len(found) > 200 and sum(any(w in x for w in ("brute", "fool", "crook")) for x in found) > 0.95 * len(found)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifiers_without_labels(labelled, module):
    docs, labels, _ = labelled
    assert module.score(docs, module.fit(docs, labels.limit(0))).count() == 903
    assert module.score(docs.limit(0), module.fit(docs, labels.limit(0))).count() == 0


def test_document_summaries_equal_plain_sums():
    source = random.Random(4)
    texts = [[source.random() for _ in range(n)] for n in (0, 1, 2, 3, 4, 50, 700)]
    first = np.cumsum([0, *map(len, texts)])
    got = toxicity.summaries(np.array([x for t in texts for x in t]), first)
    for row, text in zip(got, texts):
        none = np.prod([1 - x for x in text])
        if 1e-5 < none < 1 - 1e-5:
            assert row[0] * 4 == pytest.approx(np.log((1 - none) / none), rel=1e-6)
        assert row[1] == pytest.approx(np.log(sum(text) + 1e-2)) and row[2] == pytest.approx(np.log(sum(text) / max(1, len(text)) + 1e-4))
        most = sorted(text, reverse=True) + [1e-6] * 4
        assert row[3:].tolist() == pytest.approx([np.log(most[k - 1] / (1 - most[k - 1])) for k in toxicity.PLACES], rel=1e-5)


def test_logistic_model_of_unscaled_columns():
    source = np.random.default_rng(2)
    x = source.normal(size=(4000, 3)) * [1e-3, 1, 1e3] + [5, 0, -7]
    y = (source.random(4000) < 1 / (1 + np.exp(-(x - [5, 0, -7]) @ [2e3, -1, 1e-3]))).astype(float)
    w = toxicity.fit_logistic(x, y)
    assert w[0] / 2e3 == pytest.approx(1, abs=0.15) and w[1] == pytest.approx(-1, abs=0.15) and w[2] / 1e-3 == pytest.approx(1, abs=0.15)
    assert toxicity.fit_logistic(np.empty((0, 3)), np.empty(0)).tolist() == [0, 0, 0, 0]
