"""Packing, conversation repair and filter interaction against plain versions."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as contract
import oracle
from tablewright.llm import conversations, interaction, packing
from tablewright.llm.queries import WORD_TOKENIZER

DOCUMENT = "doc_id long, text string, source string, `sequence_id` string, __task0 string"


@pytest.fixture(scope="module")
def tokenizer():
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        return file.read()


@functools.cache
def loaded(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokenizer)


def plain_ids(tokenizer, text):
    return loaded(tokenizer).encode(text or "", add_special_tokens=False).ids + [packing.END]


def best_fit(lengths, size):
    """Sequences of best fit, longest first, piece by piece."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - length)
        else:
            room.append(size - length)
    return len(room)


TEXTS = [
    None, "", " ", "a", "Don't stop. it's We'LL 've,go a.b...c ?!x'y", "x\x1cy\x85z\xa0w v\t\nu\x0bt", "ΑΣ.Α ΟΔΟΣ. σς", "é .́ ́",
    "<|endoftext|> a<|startoftext|>.b", "漢字,かな 한글 🙂.🙂 ١٢٣ 12.5", "word " * 5000, "z" * 3000, "same words here", "same words here", "İI ẞß ﬁ",
]


def test_ids_of_words_are_those_of_whole_texts(tokenizer):
    import pyarrow as pa

    ids, first = packing.Words(tokenizer).encode(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        assert ids[first[i] : first[i + 1]].tolist() == plain_ids(tokenizer, text)[:-1], text


def test_plain_words_are_tokenized_together(tokenizer):
    """Few texts reach the tokenizer, with the ids of each word for itself; others go one by one."""
    import pyarrow as pa

    random.seed(3)
    plain = list(dict.fromkeys("".join(random.choices("abcdeéßöÿñ", k=random.randrange(1, 12))) for _ in range(3000)))
    odd = ["Éan", "\u0130x", "e\u0301a", "\u0958", "12ab", "a'll", "x***", "\u01c6", "中文", "\u200b"]
    words, given = packing.Words(tokenizer), []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return real.encode_batch_fast(texts, **options)

    real, words.tokenizer = words.tokenizer, Counting()
    text = [" ".join(plain[:1500] + odd), " ".join(odd + plain[1000:])]
    for _ in range(2):
        ids, first = words.encode(pa.array(text))
        for i in range(2):
            assert ids[first[i] : first[i + 1]].tolist() == plain_ids(tokenizer, text[i])[:-1]
        assert len(given) <= len(plain) / packing.JOINED + 1 + len(odd) + 2
    words._forget()
    words.ends = None
    assert words.encode(pa.array(text))[0].tolist() == ids.tolist()


@pytest.mark.parametrize("size", [7, 64, 2048])
def test_pieces_fill_sequences(spark, tokenizer, size):
    rows = [(i if i != 3 else None, t, "s", "kept", "other") for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, DOCUMENT).repartition(3)
    pieces = packing.pieces(df, tokenizer, size=size).withColumnRenamed("ids", "sequence_id").withColumn("__task0", packing.F.lit("mine"))
    out = packing.pack(pieces.withColumnRenamed("sequence_id", "tokens"), size).collect()
    assert all(r["__task0"] == "mine" for r in out)
    want = Counter()
    for key, text, *_ in rows:
        ids = plain_ids(tokenizer, text)
        for start in range(0, len(ids), size):
            part = ids[start : start + size]
            want[key, start // size, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.tokens)) for r in out) == want
    taken = defaultdict(list)
    for r in out:
        taken[r.sequence_id].append((r.offset, r.length))
    for slots in taken.values():
        ends = [o + n for o, n in sorted(slots)]
        assert [o for o, _ in sorted(slots)] == [0, *ends[:-1]] and ends[-1] <= size
    assert len(taken) == best_fit([r.length for r in out], size)


@pytest.mark.parametrize("seed", range(30))
def test_planned_counts_equal_best_fit_piece_by_piece(seed):
    source = random.Random(seed)
    size = source.choice([5, 16, 100])
    lengths = source.choices(range(1, size + 1), k=source.randrange(0, 300))
    if seed % 3 == 0:
        lengths += [source.randrange(1, size + 1)] * 400
    histogram = Counter(lengths)
    slots = packing.plan(histogram, size)
    assert slots.sequences == best_fit(lengths, size)
    filled = defaultdict(list)
    for length, n in histogram.items():
        where, offset = slots.place(np.full(n, length), np.arange(n))
        for w, o in zip(where.tolist(), offset.tolist()):
            filled[w].append((o, length))
    assert sorted(filled) == list(range(slots.sequences))
    for taken in filled.values():
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(sorted([*taken, (sum(n for _, n in taken), 0)])))


def test_no_rows_and_wrong_lengths(spark, tokenizer):
    empty = spark.createDataFrame([], DOCUMENT)
    assert packing.pack(packing.pieces(empty, tokenizer)).collect() == []
    for length in (0, 9, None):
        with pytest.raises(Exception, match="piece"):
            packing.pack(spark.createDataFrame([(length,)], "length long"), 8).collect()


def test_packing_query(spark, folder, tokenizer):
    out = contract.queries()["op11_packing"](spark, folder)
    assert dict(out.dtypes) | {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"} == dict(out.dtypes)
    rows = out.collect()
    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = plain_ids(tokenizer, r.text)
        for i, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[r.doc_id, i] = start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    assert len({r.sequence_id for r in rows}) == best_fit([r.length for r in rows], 2048)


# ---- conversations


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        inked = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not inked else "duplicate" if (role, text) in seen else "truncated" if inked[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """All edits within the cost of the cheapest, the pattern tested on whole results."""
    best = [(3 * len(rows), "D" * len(rows), ())]

    def walk(i, cost, edits, out):
        initials = "".join(r[:1] for r, _ in out)
        if cost > best[0][0] or not re.fullmatch("s?(ua)*u?", initials):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best[0] = min(best[0], (cost, edits, tuple(out)))
        if i < len(rows):
            role, text = rows[i]
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                walk(i + 1, cost + more, edits + "K", [*out, (role, text)])
                for new in ("user", "assistant"):
                    walk(i + 1, cost + more + 2, edits + "R", [*out, (new, text)])
            walk(i + 1, cost + 3, edits + "D", out)
        for role in ("user", "assistant"):
            walk(i, cost + 2, edits + "I", [*out, (role, "")])

    walk(0, 0, "", [])
    return best[0]


def plain_conversations(rows, damaged):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in damaged if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        messages = [r[1:] for r in own]
        faults, turns = plain_faults(messages), {r[0] for r in own} - {None}
        cost, audit, kept = plain_repair(messages, faults)
        pairs = itertools.pairwise(r[:1] for r, _ in messages)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def repaired(df):
    repairs = conversations.repair(df)
    digests = {r.conv_id: r.repaired_sha256 for r in repairs.digests().collect()}
    rows = repairs.conversations.collect()
    assert len(rows) == len(digests)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests[r.conv_id]) for r in rows}, repairs


def odd_conversations(seed, n=40):
    source, rows = random.Random(seed), []
    for conv in [*range(n), None]:
        for turn in range(source.randrange(1, 5)):
            role = source.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None])
            text = source.choice(["Fine.", "Cut off", "Why?", "", " \t\n", None, "Again!", "é.", "End. \n", "a "])
            rows.append((conv, source.choice([turn, turn, turn + 1, None, -turn]), role, text))
            if source.random() < 0.1:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block_rows", [1024, 1, 2])
def test_repairs_equal_all_edits_tried(spark, monkeypatch, block_rows):
    monkeypatch.setattr(conversations, "BLOCK_ROWS", block_rows)
    rows = odd_conversations(block_rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", task int, `rows` string")
    got, repairs = repaired(conversations.damage(df))
    assert got == plain_conversations(rows, plain_damage(rows))
    got, repairs = repaired(df)
    assert got == plain_conversations(rows, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    edits = defaultdict(list)
    for m in repairs.messages().orderBy("task", "block", "position").collect():
        edits[m.conv_id].append((m.role, m.text, m.edit))
    for conv, found in got.items():
        assert "".join(e for _, _, e in edits[conv]) == found[6].replace("D", "")
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in edits[conv]).encode()).hexdigest() == found[7]


def test_a_conversation_over_many_tasks_and_blocks(spark, monkeypatch):
    source = random.Random(7)
    rows = [(1, i, source.choice(["user", "assistant", "system"]), source.choice(["One.", "Two!", "Cut", " ", "N%d." % i, "N%d." % i])) for i in range(3000)]
    rows += [(0, i, "user", "Hi.") for i in range(3)] + [(2, 0, "assistant", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA)
    whole, _ = repaired(df.coalesce(1))
    monkeypatch.setattr(conversations, "BLOCK_ROWS", 37)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    try:
        parts, repairs = repaired(df.repartition(5))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts == whole
    assert repairs.blocks.where("conv_id = 1").select("task").distinct().count() > 1
    # One agenda over the whole conversation gives the same.
    mine = [r[2:] for r in rows[:3000]]
    faults = plain_faults(mine)
    found = conversations.derive([(r[:1], f[:1]) for (r, _), f in zip(mine, faults)], conversations.EMPTY, conversations.DONE)
    assert min(found.values()) == whole[1][5:7]


def test_very_long_text_and_equal_rows(spark):
    rows = [(1, 0, "user", "a" * 5_000_000 + "."), (1, 1, "assistant", "ok."), *[(2, 0, "user", "Same.")] * 500, (3, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, _ = repaired(df)
    assert got[1][5:7] == (0, "KK") and got[2][2] == 499 and got[2][5:7] == (499 * 3 + 2, "D" * 0 + got[2][6]) and got[2][6].count("D") == 499
    assert got[3] == (0, 1, 0, 0, 0, 3, "D", hashlib.sha256(b"").hexdigest())


def test_no_conversations(spark):
    got, repairs = repaired(conversations.damage(spark.createDataFrame([], SCHEMA)))
    assert got == {} and repairs.messages().collect() == []


def test_conversation_query(spark, folder):
    out = contract.queries()["op12_conversation_repair"](spark, folder)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_conversations(rows, plain_damage(rows))
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in out.collect()}
    assert got == want
    kinds = dict(out.dtypes)
    assert {kinds[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} == {"bigint"}


# ---- filters


def plain_audit(documents, labels):
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    text = lambda t: t or ""
    fails = []
    for key, t, part in documents:
        t = text(t)
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)),
            key is not None and any(k is not None and k < key and text(u) == t for k, u, _ in documents))) if bad})
    out = {}
    for part in {p or "" for *_, p in documents}:
        mine = [(k, f) for (k, _, p), f in zip(documents, fails) if (p or "") == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [(k, f) for k, f in left if c in f]
                left = [(k, f) for k, f in left if c not in f]
                before = set(order[: step - 1])
                out[part, "".join(order), step] = [len(left), len(gone), sum(c in f and bool(f & before) for _, f in mine), sum(f == {c} for _, f in mine),
                                                   sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone), c]
                shapley[c] += len(gone)
        for (p, *_), row in out.items():
            if p == part:
                row[-1] = shapley[row[-1]] if isinstance(row[-1], str) else row[-1]
    return {k: tuple(v) for k, v in out.items()}


def test_interaction_equals_filters_applied_one_by_one(spark):
    source = random.Random(3)
    texts = [None, "", " \x0b", "Short TEXT", "100%", "a b " * 150, " ".join(f"w{i}" for i in range(250)), "ABC " * 300, " ".join(f"W{i}|" for i in range(400)), "é" * 10_000, "x" * 400_000]
    documents = [(source.choice([None, *range(40)]), source.choice(texts), source.choice(["a", "b", "", None])) for _ in range(300)]
    documents += [documents[0]] * 5 + [(7, "Short TEXT", "a"), (7, "Short TEXT", "b"), (99, None, "a")]
    labels = [(i % 45 if i % 9 else None, source.choice([0, 1, None]), source.choice([0, 1, None])) for i in range(60)]
    df = spark.createDataFrame([(*d, 5, "x") for d in documents], "doc_id long, text string, source string, mask int, part string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = interaction.audit(interaction.document_masks(df, marks), "ABCDE").collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in interaction.COUNTS) for r in out}
    assert len(out) == len(got) and got == plain_audit(documents, labels)


def test_wide_fields_do_not_overflow():
    fields = interaction.Fields("AB")
    many = 2**62 - 1
    rows = {(o, s): c for o, s, c in fields.rows([(0, many, 0, 0), (3, many, many, 1), (1, 1, 0, 0)])}
    assert rows["AB", 1] == (many, many + 1, 0, 1, many, 1, many + 1 + 1)
    assert rows["AB", 2] == (many, 0, many, 0, 0, 0, many)
    assert rows["BA", 2] == (many, 1, many, 1, 0, 0, many + 1 + 1)


def test_no_documents_and_other_filters(spark):
    documents, labels = spark.createDataFrame([], DOCUMENT), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(interaction.document_masks(documents, labels), "ABCDE").collect() == []
    rows = spark.createDataFrame([("p", 2, 3, 1, 0), (None, 0, 1, 0, 0)], "part string, mask int, n long, good long, toxic long")
    assert interaction.audit(rows, "XYZ").count() == 2 * 6 * 3


def test_interaction_query_against_sql(spark, folder):
    assert oracle.compare(contract.queries()["op13_filter_interaction"](spark, folder), oracle.connect(folder), contract.oracle_sql()["op13_filter_interaction"]) is None
