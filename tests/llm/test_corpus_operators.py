"""Operators across documents against brute force: joins, suffix arrays, links, licenses, the pipeline."""

import hashlib
import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
import oracle
from tablewright.llm import decontaminate, jaccard, licenses, suffixes, urls
from tablewright.llm.common import Store, components


def words(source, n):
    return ["".join(source.choices("abcdefg", k=source.randrange(2, 6))) for _ in range(n)]


def corpus(seed):
    """Copies, near copies on both sides of the threshold, a common line, a common passage, edge cases."""
    source = random.Random(seed)
    line, passage = words(source, 9), words(source, 70)
    docs, base = [], words(source, 120)
    for i in range(160):
        kind = i % 8
        if kind == 0:
            text = base[:]
            for _ in range(source.randrange(0, 7)):
                text[source.randrange(len(text))] = "changed%d" % source.randrange(10**6)
        elif kind == 1:
            text = line + words(source, source.randrange(1, 40))
        elif kind == 2:
            text = words(source, 40) + passage + words(source, 40)
        elif kind == 3:
            text = words(source, source.randrange(0, 16))
        elif kind == 4:
            text = docs[-4][1].upper().split(" ") if docs else []
        elif kind == 5:
            text = ["again"] * source.randrange(1, 200)
        elif kind == 6:
            text = docs[-6][1].split(" ")[:-1]
        else:
            text = words(source, source.randrange(100, 400))
        docs.append((i * 3, " ".join(text)))
    return docs + [(1000, None), (1001, ""), (1002, " \n"), (None, "a b c d e f"), (1003, "ü ß a b c d"), (1004, "a b c d e f"), (1005, "á" * 3000)]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 0.5, "x") for i, t in docs], "doc_id long, text string, c double, component_id string").repartition(7)


def linked(docs):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for i, t in docs:
        w = (t or "").encode().translate(low).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}
    ids = sorted(i for i in sets if i is not None)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                n = len(sets[a] & sets[b])
                if a < b and n and 100 * n >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return {i: (len(sets[i]), group[i]) for i in ids}


@pytest.mark.parametrize("seed, block, tiny", [(1, 2048, 9), (2, 4, 9)])
def test_jaccard_join(spark, monkeypatch, seed, block, tiny):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = corpus(seed)
    rows = jaccard.join(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == linked(docs)
    assert [(r.n_shingles, r.component_id) for r in rows if r.doc_id is None] == [(2, None)]


def test_jaccard_join_of_nothing(spark):
    assert jaccard.join(frame(spark, corpus(1)).limit(0)).count() == 0


def test_similar_sets_share_a_signature():
    """Random sets around every size, just above the threshold, with and without frequent elements."""
    import numpy as np

    source = np.random.default_rng(5)
    for size in [*range(1, 60), 90, 150, 400, 1500]:
        for some in (0.0, 0.05, 0.2, 0.32, 0.6, 1.0):
            a = np.unique(source.integers(1, 1 << 62, size).astype(np.uint64))
            both = len(a)
            for out in range(both // 4, -1, -1):
                more = max((4 * (both - out) - 3 * both) // 3, 0)
                if 100 * (both - out) >= 75 * (both + more):
                    break
            b = np.sort(np.concatenate([a[source.permutation(both)[out:]], source.integers(1, 1 << 62, more).astype(np.uint64)]))
            hot = np.sort(np.unique(np.concatenate([a, b]))[: int(some * both)])
            sig, row = jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), hot)
            assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist()), (size, some)


def removed(docs):
    seen, out = set(), {}
    for i, t in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]) + [d for d in docs if d[0] is None]:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - suffixes.LENGTH + 1):
            part = data[s : s + suffixes.LENGTH]
            if part in seen:
                gone[s : s + suffixes.LENGTH] = b"\1" * suffixes.LENGTH
            seen.add(part)
        left = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(left).hexdigest(), left)
    return out


@pytest.mark.parametrize("seed, spread, shard", [(1, 4096, 1 << 19), (2, 2, 600)])
def test_suffix_dedup(spark, monkeypatch, seed, spread, shard):
    """With tiny shards and few occurrences each, equal strings must be merged across shards."""
    docs = corpus(seed)
    monkeypatch.setattr(suffixes, "SPREAD", spread)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", shard)
    df, expected = frame(spark, docs), removed(docs)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removals(df).collect()}
    assert got == {i: v[:4] for i, v in expected.items()}
    left = {r.doc_id: r.text for r in suffixes.deduplicate(df).collect()}
    assert left == {i: None if t is None else expected[i][4].decode(errors="ignore") for i, t in docs}


def test_suffix_dedup_counts_equal_rows_once(spark):
    text = " ".join(words(random.Random(7), 80))
    df = frame(spark, [(1, text), (1, text), (2, text), (3, "short")])
    rows = sorted((r.doc_id, r.n_removed) for r in suffixes.removals(df).collect())
    assert rows == [(1, 0), (1, 0), (2, len(text)), (3, 0)]
    assert suffixes.removals(df.limit(0)).count() == 0


def test_components_of_chains_stars_and_nulls(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(500, i) for i in range(501, 900)]
    df = spark.createDataFrame([*chain, *star, (7, 7), (None, 3), (950, 940), (940, 950)], "a long, b long")
    got = {r.node: r.component for r in components(df, Store(spark)).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(500, 900), 500), 940: 940, 950: 940}


RULES = [urls.Rule("net/", False), urls.Rule("example.net/en/", True), urls.Rule("bad.org/", False)]


def test_url_aliases(spark):
    link = '<link href="%s" rel="canonical">'
    rows = [
        (1, "http://A.Bad.org/x#f", None),  # blocked by a rule
        (2, "https://alias.com/a", link % "http://a.bad.org/x"),  # its alias
        (3, "https://alias.com/b?q=1", link % "/a"),  # alias of the alias, relative
        (4, "https://alias.com/c", '<meta http-equiv=refresh content="0; url=//x.example.net/en/1">'),  # alias of an allowed url
        (5, "https://alias.com/d", link % "/c" + '<META HTTP-EQUIV="Refresh" CONTENT="5;URL=http://a.bad.org/x">'),  # of both: allow
        (6, "http://b.net/z", link % "http://x.example.net/en/1"),  # its own rule wins
        (7, None, link % "http://a.bad.org/x"), (8, "no scheme", ""), (9, "http://free.com", ""), (9, "http://free.com", ""), (10, "http://notnet/en/", None),
    ]
    pages = spark.createDataFrame([(*r, "y") for r in rows], "page_id long, url string, html string, verdict string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, RULES).collect())
    verdict = {g[0]: g[4] for g in got}
    # 5 joins both components: the explicit allow outweighs the block for all without a rule.
    assert verdict == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "allow", 8: "allow", 9: "allow", 10: "allow"}
    assert got[0] == (1, "a.bad.org", "/x", "bad.org/", "block") and len(got) == 11
    apart = {r.page_id: r.verdict for r in urls.judge(pages.where("page_id <> 5"), RULES).collect()}
    assert (apart[2], apart[3], apart[4]) == ("block", "block", "allow")
    log = spark.createDataFrame([("http://free.com", "http://a.bad.org/x")], "url string, target string")
    assert {r.verdict for r in urls.judge(pages.where("page_id = 9"), RULES, log).collect()} == {"block"}
    assert urls.judge(pages.limit(0), RULES).count() == 0


def test_url_aliases_of_every_form(spark):
    """Each target, on the page http://a.com/d/e/p?x=1, against urljoin of the standard library."""
    from html import unescape
    from urllib.parse import urljoin

    page, link = "http://a.com/d/e/p?x=1", '<link rel="canonical" href="%s">'
    targets = ["next.html", "?p=1", "../x", "./", "../../../y/./z?q=../r", "/r/../s", "//b.org/t", "https://c.org/u", "v?to=http://w.org/", "..",
               "/i?a=1&amp;b=2", "j&#38;k&#x26;l", "m&amp;lt;x", "&eacute;&#x1F642;", "n&unknown;&#xD800;x"]
    html = "".join(link % t for t in targets) + "".join(f'<meta http-equiv="refresh" content="0; url={t}">' for t in ("first", "second")) + link % "#top"
    pages = spark.createDataFrame([(1, page, html), (2, "http://e.com", link % "f"), (3, "http://g.com/", None), (4, None, link % "h")], "page_id long, url string, html string")
    got = sorted((r.url, r.target) for r in urls.aliases(pages).collect())
    assert got == sorted([(page, urljoin(page, unescape(t))) for t in [*targets, "first", "second"]] + [("http://e.com", "http://e.com/f")])
    blocked = spark.createDataFrame([(1, "http://q.com/a?b=1&c=2", ""), (2, "http://bad.org/d/p", link % "http://q.com/z" + link % "http://q.com/a?b=1&amp;c=2")], "page_id long, url string, html string")
    assert {r.verdict for r in urls.judge(blocked, RULES).collect()} == {"block"}


def test_columns_named_like_helpers(spark):
    """Columns that the operators use inside come back as they went in."""
    text = " ".join(f"word{i}" for i in range(60))
    alone = " ".join(f"alone{i}" for i in range(12))
    rows = [(1, text, 10, "a", 20, 30.5), (2, f"{alone} {text}", 11, "b", None, 31.5), (None, "short", 12, None, 22, 32.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row long, __left string, __id long, __TIE double")
    left = {r["__row"]: tuple(r) for r in suffixes.deduplicate(docs).collect()}
    assert left[10] == rows[0] and left[12] == rows[2]
    assert left[11][0] == 2 and left[11][1].rstrip() == alone and left[11][2:] == rows[1][2:]
    benchmark = spark.createDataFrame([(1, alone), (None, "short")], "item_id long, text string")
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and sorted((tuple(r) for r in kept.collect()), key=lambda r: r[2]) == [rows[0], rows[2]]
    one = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert one.columns == docs.columns and sorted((tuple(r) for r in one.collect()), key=lambda r: r[2]) == [rows[0], rows[2]]


LINKS = [
    ("<!-- <link rel=canonical href='http://a.com/1'> --><link rel='alternate  Canonical' title=\"rel=x href=y\" data-href='http://a.com/2' href=\"http://a.com/it's\">", "http://a.com/it's"),
    ("<script>'<link rel=canonical href=http://a.com/1>'</script><LINK HREF=http://a.com/it's REL=canonical>", "http://a.com/it's"),
    ("<link rel=canonical-x href=http://a.com/1><link rel=canonical><link href=' http://a.com/\n3 ' href=http://a.com/4 rel=canonical/>", None),
    ("<link href=' http://a.com/\n3 ' href=http://a.com/4 rel=canonical >", "http://a.com/3"),
    ("<meta name=x content='0;url=http://a.com/1'><meta content=\"0; URL='http://a.com/5?a=b&amp;c'\" http-equiv=Refresh>", "http://a.com/5?a=b&c"),
    ("<meta http-equiv=refresh content=5><link rel=canonical href=>", None), ("<!--><link rel=canonical href=?q=1>", "http://p.com/d/e?q=1"),
    ("<link rel=canonical href=f/g>", "http://p.com/d/f/g"), ("<!-- <link rel=canonical href=http://a.com/1>", None),
    ("<link rel=canonical href=\"http://a.com/6><p>\"", None), ("<link rel=canonical href=http://a.com/1" * 2000, None), ("<link " + "a='b' " * 30000 + ">", None),
]


def test_url_aliases_by_attributes(spark):
    pages = spark.createDataFrame([(i, "http://p.com/d/e", page) for i, (page, _) in enumerate(LINKS)], "page_id long, url string, html string")
    for i, (_, target) in enumerate(LINKS):
        assert [r.target for r in urls.aliases(pages.where(f"page_id = {i}")).collect()] == [target] * (target is not None), i


def test_url_query_against_sql_on_linked_pages(spark, tmp_path):
    """Pages that block, allow or name one another by links of all these forms."""
    source = random.Random(6)
    hosts = ["http://a.com", "http://b.example.com", "https://c.net", "http://d.org", "http://e.example.net"]
    at = lambda: f"{source.choice(hosts)}/{source.choice(['de', 'en', 'fr', 'x'])}/{source.randrange(40)}"
    forms = ["<link rel=canonical href=%s>", "<link data-href='http://c.net/' href=\"%s\" rel='alternate canonical'>", "<!-- <link rel=canonical href=%s> -->",
             "<meta http-equiv=refresh content=\"0;url=%s\">", "<link rel=next href=%s>", "<script><link rel=canonical href=%s></script>"]
    rows = []
    for i in range(400):
        target = source.choice([at(), at(), f"{source.randrange(40)}", f"/fr/{source.randrange(40)}", "?q=1&amp;r=2"])
        rows.append((i, at(), "".join(source.choice(forms) % target for _ in range(source.randrange(3)))))
    rows += [(400, None, None), (401, "http://a.com/de/1", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/w")
    (part,) = (tmp_path / "w").glob("*.parquet")
    part.rename(tmp_path / "pages.parquet")
    got = contract.queries()["op1_url_filter"](spark, str(tmp_path))
    assert oracle.compare(got, oracle.connect(str(tmp_path)), contract.oracle_sql()["op1_url_filter"]) is None
    assert got.where("rule IS NULL AND verdict = 'block'").count() > 10


def test_license_scan(spark):
    source = random.Random(3)
    noise = lambda n: " ".join(words(source, n))
    docs = [(i, f"{noise(3 + i)} {text.upper()} {noise(9)}", 1) for i, text in enumerate(licenses.TEMPLATES.values())]
    docs += [(100, None, 1), (101, "", 1), (102, "license", 1), (103, noise(5000), 1), (0, noise(4), 1)]
    found = {(r.doc_id, r.template) for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string, template int")).collect()}
    assert {(i, name) for i, name in enumerate(licenses.TEMPLATES)} <= found
    assert not {i for i, _ in found} & {100, 101, 102, 103}


def test_license_scan_finds_short_templates(spark):
    """Random templates of two words and more between random words, verbatim: none is missed."""
    source = random.Random(8)
    say = lambda n: " ".join("".join(source.choices("abcdefghijklmnop", k=7)) for _ in range(n))
    templates = {f"{n} {i}": say(n) for n in range(2, 12) for i in range(12)}
    docs = [(d, f"{say(source.randrange(3, 12))} {text} {say(8)}") for d, text in enumerate(t for t in templates.values() for _ in range(15))]
    found = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"), templates).collect()
    names = list(templates)
    assert sorted((r.doc_id, r.template) for r in found) == [(d, names[d // 15]) for d, _ in docs]


@pytest.mark.parametrize("name", ["op1_url_filter", "op6_license_scan"])
def test_query_against_sql(name, spark, folder):
    df = contract.queries()[name](spark, folder)
    assert oracle.compare(df, oracle.connect(folder), contract.oracle_sql()[name]) is None
    assert "Python" not in (plan := df._jdf.queryExecution().toString()) and "Arrow" not in plan


def test_join_and_dedup_queries(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in contract.queries()["op8_jaccard_join"](spark, folder).collect()}
    assert got == linked(docs)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in contract.queries()["op3_suffix_dedup"](spark, folder).collect()}
    assert got == {i: v[:4] for i, v in removed(docs).items()}


def test_pipeline(spark, folder):
    """Each stage takes what it should from its own input, and the last one keeps every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    store, columns = Store(spark), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = store.put(stage(spark, docs, folder), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        if name == "ngram_jaccard_join":
            assert set(after) == {g for _, g in linked(before.items()).values()}
        if name == "suffix_array_dedup":
            assert after == {i: v[4].decode(errors="ignore") for i, v in removed(list(before.items())).items()}
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert len(tokens) == docs.count() and all(r.exact for r in tokens)


def test_stages_take_rows_and_not_ids(spark, folder):
    """Ids that repeat or are null: near copies and rows with a benchmark item go, and no others."""
    source = random.Random(12)
    a, b, c, d, e = ([*words(source, 90)] for _ in range(5))
    near = [*a[:-1], "changed"]
    texts = {k: " ".join(v) for k, v in dict(a=a, b=b, c=c, d=d, e=e, near=near).items()}
    rows = [(1, "a"), (1, "b"), (2, "near"), (None, "b"), (None, "c"), (3, "c"), (None, "d"), (None, "d"), (5, "near"), (5, "e"), (5, "e")]
    docs = frame(spark, [(i, texts[t]) for i, t in rows] + [(6, ""), (6, None)])
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.one_of_each_group(spark, docs, folder).collect()]
    assert sorted(kept, key=str) == sorted([(1, texts["a"]), (1, texts["b"]), (3, texts["c"]), (None, texts["d"]), (5, texts["e"]), (6, ""), (6, None)], key=str)

    benchmark = spark.createDataFrame([(1, " ".join(b[20:50]) + ". " + " ".join(b[50:65]) + ".")], "item_id long, text string")
    left = decontaminate.clean(docs, benchmark).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted([(i, texts[t]) for i, t in rows if t != "b"] + [(6, ""), (6, None)], key=str)


def _blocks(source, n, two_sides):
    import numpy as np

    base = source.getrandbits(256)
    words = []
    for _ in range(n):
        bits = base
        for _ in range(source.randrange(0, 24)):
            bits ^= 1 << source.randrange(256)
        words.append(np.frombuffer(bits.to_bytes(32, "little"), np.uint64))
    side = np.array([source.randrange(2) for _ in range(n)]) if two_sides else None
    return jaccard._Block(np.array([source.randrange(90, 110) for _ in range(n)], np.int64), np.array([source.randrange(n) for _ in range(n)]), np.array(words), side)


def _united(block, pairs):
    root = list(range(len(block.n)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(root)):
        for y in range(x):
            if block.group[x] == block.group[y]:
                root[find(x)] = find(y)
    for x, y in pairs:
        root[find(x)] = find(y)
    return [[find(x) == find(y) for y in range(len(root))] for x in range(len(root))]


@pytest.mark.parametrize("seed", range(20))
def test_forests_join_what_all_pairs_join(seed):
    block = _blocks(random.Random(seed), 30, seed % 2 == 1)
    pairs, forest = block.pairs(None), block.forest()
    assert set(map(tuple, map(sorted, forest))) <= set(map(tuple, map(sorted, pairs))) and len(forest) < len(block.n)
    assert _united(block, forest) == _united(block, pairs)
    assert block.pairs(len(pairs)) == pairs and (not pairs or block.pairs(len(pairs) - 1) is None)


def test_blocks_with_more_pairs_than_members(spark, monkeypatch):
    """A long chain of near copies around the threshold: forests, and what they cut off, give all links."""
    source = random.Random(11)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    text, docs = words(source, 90), []
    for i in range(150):
        docs.append((i, " ".join(text)))
        for _ in range(source.randrange(1, 4)):
            text[source.randrange(len(text))] = "n%d" % source.randrange(10**6)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.join(df).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(86)} for i, t in docs}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if group[a] < group[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    group[b], changed = group[a], True
    assert got == group


def test_folded_sketches_rule_out_no_similar_pair():
    """A block's sketch is that of fewer cells; it differs in at most as many bits as the whole one."""
    import numpy as np

    source = random.Random(3)
    one, other = ([source.randrange(1024) for _ in range(n)] for n in (300, 320))
    for width in (64, 256, 1024, 4096):
        whole, few = ([np.bincount([x % w for x in cells], minlength=w) & 1 for cells in (one, other)] for w in (1024, min(width, 1024)))
        folded = [jaccard._folded(parity, width) for parity in whole]
        assert all((a == b).all() for a, b in zip(folded, few))
        assert (folded[0] != folded[1]).sum() <= (whole[0] != whole[1]).sum()


def test_blocks_are_sent_with_small_sketches():
    """A set goes to every block of its signatures, so its sketch there is at most a fifth of the whole one."""
    import pyarrow as pa
    import zstandard

    source = random.Random(4)
    packs = [zstandard.ZstdCompressor().compress(" ".join(words(source, n)).encode()) for n in (100, 250, 400)]
    batch = pa.RecordBatch.from_arrays([pa.array([b"%d" % i for i in range(3)], pa.binary()), pa.array(packs, pa.binary())], names=["c", "z"])
    (rows,) = jaccard._sketch(iter([batch]))
    assert all(5 * len(r["few"]) <= len(r["bits"]) for r in rows.to_pylist())


@pytest.mark.parametrize("seed", range(10))
def test_blocks_look_at_pairs_in_steps(seed, monkeypatch):
    """However few pairs a step has, a block gives those of a comparison one by one."""
    import numpy as np

    block = _blocks(random.Random(seed), 40, seed % 2 == 1)
    want = [(x, int(y)) for x in range(40) for y in block.near(x, np.arange(x + 1, 40))[0]]
    for at_once in (1, 100, 1 << 20):
        monkeypatch.setattr(jaccard, "AT_ONCE", at_once)
        assert block.pairs(None) == want


def _near_rows(source, n, changes, two_sides):
    """Rows of one block, near copies of a text, with their compressed texts and with their sketches; and the links."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    base, packs = words(source, 100), []
    for _ in range(n):
        text = base[:]
        for at in source.sample(range(100), source.randrange(changes + 1)):
            text[at] = "n%d" % source.randrange(10**6)
        packs.append(zstandard.ZstdCompressor().compress(" ".join(text).encode()))
    sets = [jaccard._set_of(z, jaccard.Powers()) for z in packs]
    band = int(np.searchsorted(jaccard.LOW, 96, side="right")) - 1
    side, names = [source.randrange(2) for _ in range(n)], [b"%03d" % i for i in range(n)]
    keys = [pa.array([k] * n, t) for k, t in ((64 + band, pa.int64()), (0, pa.int32()), (int(two_sides), pa.int32()))]
    keys += [pa.array(side, pa.int32()), pa.array(names, pa.binary()), pa.array([b"%d" % source.randrange(n) for _ in range(n)], pa.binary())]
    bits = [np.packbits(jaccard._parity(s, band).astype(bool)).tobytes() for s in sets]
    columns = ["sig", "i", "j", "side", "c", "g"]
    texts = pa.RecordBatch.from_arrays([*keys, pa.array(packs, pa.binary())], names=[*columns, "z"])
    sketches = pa.RecordBatch.from_arrays([*keys, pa.array([len(s) for s in sets], pa.int32()), pa.array(bits, pa.binary())], names=[*columns, "n", "bits"])
    links = [(x, y) for x in range(n) for y in range(x) if (side[x] != side[y] or not two_sides) and jaccard._link(sets[x], sets[y])]
    return texts, sketches, links


@pytest.mark.parametrize("seed", range(6))
def test_blocks_of_texts_give_fewer_links_than_members(seed, monkeypatch):
    """They join what all links of the block join, in however few bytes; and so does no step give all pairs."""
    import numpy as np

    rows, sketches, links = _near_rows(random.Random(seed), 60, (2, 4, 7)[seed % 3], seed % 2 == 1)
    names = rows.column(4).to_pylist()
    block = jaccard._Block(np.zeros(60), rows.column(5).dictionary_encode().indices.to_numpy(), None, None)
    for held in (1, 1 << 24):
        monkeypatch.setattr(jaccard, "BLOCK_BYTES", held)
        got = [(names.index(r["a"]), names.index(r["b"])) for out in jaccard._joined(iter([rows.slice(0, 17), rows.slice(17)])) for r in out.to_pylist()]
        assert set(map(tuple, map(sorted, got))) <= set(map(tuple, map(sorted, links))) and len(got) < len(names)
        assert _united(block, got) == _united(block, links)
    assert len(links) > len(names)
    assert sum(out.num_rows for out in jaccard._across(iter([sketches]))) < len(names)


@pytest.mark.parametrize("bytes_", [400, 1 << 24])
def test_blocks_that_stay_cut_are_compared_by_their_texts(spark, monkeypatch, bytes_):
    """Near copies on both sides of the threshold where every block gives a forest: the links are still all found."""
    source = random.Random(13)
    base, docs = words(source, 60), []
    for i in range(120):
        text = base[:]
        for at in source.sample(range(60), source.randrange(1, 4)):
            text[at] = "n%d" % source.randrange(10**6)
        docs.append((i, " ".join(text)))
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", bytes_)
    pairs, put, labels = jaccard._Block.pairs, Store.put, []
    monkeypatch.setattr(jaccard._Block, "pairs", lambda self, most: None if most is not None else pairs(self, None))
    monkeypatch.setattr(Store, "put", lambda self, df, label: (labels.append(label), put(self, df, label))[1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == linked(docs) and labels.count("links") == 4


def test_links_to_the_smallest_node_need_no_round(spark, monkeypatch):
    put, labels = Store.put, []
    monkeypatch.setattr(Store, "put", lambda self, df, label: (labels.append(label), put(self, df, label))[1])
    links = spark.createDataFrame([(1, 5), (7, 1), (9, 2), (2, 2), (None, 4)], "a long, b long")
    assert sorted(map(tuple, components(links, Store(spark)).collect())) == [(1, 1), (2, 2), (5, 1), (7, 1), (9, 2)]
    assert labels == ["edges"]
    assert components(links.limit(0), Store(spark)).count() == 0
