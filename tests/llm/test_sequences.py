"""Language model, token alignment and conversation repair against plain Python, and on odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.test_edges import EXTRA, LONG, ROWS, table
from tidefold.llm import alignment, chunks, maxent, packing, turns

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def lowered(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text)] + [""]


def test_language_model_counts(docs, texts):
    got = {r.doc_id: r for r in maxent.score(docs).collect()}
    assert set(got) == set(texts)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = collections.Counter(w for i, t in texts.items() if not held[i] for w in lowered(t))
    n, v = sum(count.values()), len(count)
    for i, text in texts.items():
        words = lowered(text)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(words), sum(count[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words))
    for side in (True, False):
        assert sum(r.score for r in got.values() if r.held_out == side) > sum(r.base_score for r in got.values() if r.held_out == side)


def test_language_model_is_a_distribution():
    """Over all slots, and within a slot over its words and one unknown one, probabilities sum to one."""
    rng = np.random.default_rng(5)
    own = rng.integers(0, 2**63, maxent.OWN).astype(np.uint64)
    model = maxent.Model(own, rng.integers(0, 50, maxent.SLOTS), rng.integers(1, 5, maxent.SLOTS), 9000, 900)
    model.by_class[:], model.by_slot[:] = rng.normal(size=model.by_class.shape), rng.normal(size=model.by_slot.shape)
    history = rng.integers(0, maxent.SLOTS, 3)
    after = np.concatenate([np.append(history, s) for s in range(maxent.SLOTS)])
    chance = maxent.log_probability(model, after, maxent.features(after, np.arange(0, len(after), 4)))[3::4]
    assert np.exp(chance).sum() == pytest.approx(1, abs=1e-4)
    inside, kinds = model.inside[7], model.kinds[7]
    assert math.exp(model.spread[7]) == pytest.approx(inside + kinds + 1)
    assert model.slots(own[[3, 9]]).tolist() == [3, 9] and model.slots(np.array([123], np.uint64))[0] >= maxent.OWN


def test_language_model_learns_context(spark):
    """Words that follow each other every time become likely, in held-out texts too."""
    rng = random.Random(1)
    rows = [(i, " ".join(itertools.chain.from_iterable(rng.choice((("a", "b", "c"), ("d", "e", "f"))) for _ in range(200)))) for i in range(80)]
    got = maxent.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert len(got) > 3 and all(r.score > r.base_score + 20 for r in got)


def test_words_beyond_ascii_and_in_other_cases(spark):
    rows = [(1, "Ä a A É é"), (2, "ä a\x0ba É é"), (3, None)]
    got = {r.doc_id: r for r in maxent.score(spark.createDataFrame(rows, "doc_id long, text string"), fold=9).collect()}
    assert [got[i].n_tokens for i in (1, 2, 3)] == [5, 5, 1] and got[1].train_tokens == 11


def test_chunks_of_any_size_give_the_same_counts(docs, monkeypatch):
    whole = {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in maxent.score(docs).collect()}
    monkeypatch.setattr(maxent, "CHUNK_BYTES", 5000)
    assert {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in maxent.score(docs).collect()} == whole


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}
    entries = {i: bytes(letters[c] for c in w) for w, i in first.get_vocab().items() if i != 50256}
    second = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def piece(i):
        shown = second.id_to_piece(i)
        return bytes([int(shown[3:5], 16)]) if second.is_byte(i) else shown.replace("▁", " ").encode()

    return lambda t: first.encode(" " + t, add_special_tokens=False).ids, entries.get, second.encode, piece


def aligned(texts, tokenizers):
    """What alignment has to give, by walking along both token lists."""
    encode_a, bytes_a, encode_b, bytes_b = tokenizers
    linked, shown = [], []
    for text in texts:
        a, b = (encode_a(text), encode_b(text)) if text else ([], [])
        parts = [bytes_a(i) for i in a], [bytes_b(i) for i in b]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            linked.append([])
            shown.append((0, 0, 0, ""))
            continue
        ends = [list(itertools.accumulate(map(len, p))) for p in parts]
        pairs, groups, i, j, mine = [], [], 0, 0, ([a[0]], [b[0]])
        while True:
            pairs.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            if x == y:
                groups.append("|".join(",".join(map(str, m)) for m in mine))
                mine = ([], [])
            i, j = i + (x <= y), j + (y <= x)
            if i == len(a):
                break
            if x <= y:
                mine[0].append(a[i])
            if y <= x:
                mine[1].append(b[j])
        linked.append(pairs)
        shown.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = collections.Counter(p for pairs in linked for p in set(pairs))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(*s[:3], len(p), sum(count[x] == best[x[0]] for x in p), sum(count[x] for x in p), s[3]) for s, p in zip(shown, linked, strict=True)]


def rows_of(df):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((r.doc_id, *(r[n] for n in names)) for r in df.collect())


def test_alignment(docs, texts, tokenizers):
    want = aligned(texts.values(), tokenizers)
    assert rows_of(alignment.align(docs)) == sorted((i, *w) for i, w in zip(texts, want, strict=True))


ODD = ["", " ", "  a▁b", "<|endoftext|> <s> <0x41> <unk>", "\n\n\t", "日本\U0001f600é", "x" * 3000, "\x00 \x7f ", "same", "same", LONG[:20000]]


def test_alignment_of_odd_texts(spark, tokenizers, monkeypatch):
    rows = list(enumerate(ODD)) + [(99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((i, *w) for (i, _), w in zip(rows, aligned([t or "" for _, t in rows], tokenizers), strict=True))
    assert rows_of(alignment.align(df)) == want
    assert sum(w[1] == 0 for w in want) >= 2
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 10)
    assert rows_of(alignment.align(df)) == want


def test_special_tokens_of_packing(spark):
    """The tokenizer file's own reading, which knows the special token by its name."""
    got = packing.split(spark.createDataFrame([(1, "hello <|endoftext|> world")], "doc_id long, text string")).collect()
    want = np.array([31373, 220, 50256, 995, 2], "<u4")
    assert [(r.length, r.ids_crc32) for r in got] == [(5, zlib.crc32(want.tobytes()))]


# Conversations.


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = out.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for own in out.values():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).digest()))
    return out


NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def solved(rows):
    """Cheapest and least audit over (rows done, last letter), whole conversations at once."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not solid else "d" if (role, text) in seen else "-" if solid[-1] in ".!?" else "t")
        seen.add((role, text))

    def put(into, at, way):
        into[at] = min(into.get(at, way), way)

    def with_inserts(best):
        best = dict(best)
        for _ in range(3):
            for at, (cost, audit) in list(best.items()):
                for letter in NEXT[at].replace("s", ""):
                    put(best, letter, (cost + 2, audit + "I"))
        return best

    best = {"": (0, "")}
    for (_, role, _), fault in zip(rows, faults, strict=True):
        new = {}
        for at, (cost, audit) in with_inserts(best).items():
            put(new, at, (cost + 3, audit + "D"))
            if fault in "-t":
                cost += fault == "t"
                for letter in NEXT[at]:
                    if role[:1] == letter:
                        put(new, letter, (cost, audit + "K"))
                    elif letter != "s":
                        put(new, letter, (cost + 2, audit + "R"))
        best = new
    best = with_inserts(best)
    cost, audit = min(best[x] for x in ("", "a") if x in best)
    lines, at, left = [], "", iter(rows)
    for edit in audit:
        _, role, text = next(left) if edit != "I" else (0, "", "")
        if edit != "D":
            role = role if edit == "K" else "assistant" if at == "u" else "user"
            lines.append(f"{role}:{text}")
            at = role[0]
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(rows))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *(faults.count(x) for x in "bdt"), illegal, cost, audit, digest


def repaired(df, **options):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    found = turns.repair(df, **options).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[n] for n in names) for r in found}


def expected(df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    return {conv: solved(own) for conv, own in damaged(rows).items()}


CONVERSATION = "conv_id long, turn long, role string, text string"


def test_repair(spark):
    df = spark.read.parquet(f"{DATA}/conversations.parquet")
    assert repaired(df) == expected(df)


@pytest.mark.parametrize("size", [1, 4, 32])
def test_repair_of_disorder(spark, size):
    """Nulls, ties, repeats, roles of any kind, no conversation, and one conversation across many blocks and tasks."""
    rng = random.Random(size)
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "umpire"]
    pool = [None, "", ".", "a.", "b", "c!", "d? ", "e\n", " "]
    rows = []
    for conv in [*range(60), None, 2**62]:
        for _ in range(rng.choice([1, 3, 6, 9, 40])):
            rows.append((conv, rng.choice([None, *range(30)]), rng.choice(roles), rng.choice([*pool, f"{rng.random()}.", f"{rng.random()}"])))
    rows += [(777, k // 2, rng.choice(roles[:5]), f"{rng.random()}" + rng.choice([".", ""])) for k in range(800)]
    df = spark.createDataFrame(rows + rows[:50], CONVERSATION).repartition(5).withColumns({c: F.lit(1) for c in ("conv", "tag", "n", "part", "block", "kind", "last")})
    got = repaired(df, size=size)
    assert got == expected(df) and len(got[777][6]) > 700


def test_repair_without_rows(spark):
    none = spark.createDataFrame([], CONVERSATION)
    assert repaired(none) == {}
    # A conversation whose only turn the damage drops.
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = repaired(spark.createDataFrame([(5, turn, "user", "x.")], CONVERSATION))
    assert got == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_tables_equal_search_of_all_edits():
    """Blocks from every state to every other, against a listing of all edits."""
    for rows in map("".join, itertools.product("suatA-", repeat=3)):
        for entry in turns.STATES:
            best = {}
            for moves in itertools.product(("D", "ID", "M", "IM", "IID", "IIM"), repeat=len(rows)):
                for found in followed(rows, "".join(moves), entry):
                    at, way = found
                    best[at] = min(best.get(at, way), way)
            assert turns.align(rows, entry) == best


def followed(rows, moves, entry):
    ways = [(entry, 0, "")]
    left = iter(rows)
    for move in moves:
        row = next(left) if move != "I" else None
        new = []
        for at, cost, audit in ways:
            for to in turns._AFTER[at]:
                if move == "I" and to != turns.SYSTEM:
                    new.append((to, cost + 2, audit + "I"))
                if move == "M" and row != turns.GONE:
                    keeps = row.lower() == turns._INITIALS[to]
                    if keeps or to != turns.SYSTEM:
                        new.append((to, cost + row.isupper() + 2 * (not keeps), audit + "RK"[keeps]))
            if move == "D":
                new.append((at, cost + 3, audit + "D"))
        ways = new
    return [(at, (cost, audit)) for at, cost, audit in ways]


@pytest.mark.parametrize("operator", [maxent.score, alignment.align])
def test_odd_rows(spark, operator):
    got = operator(table(spark, ROWS).withColumns({c: F.lit(1) for c in (*EXTRA, "chunk", "kind", "places", "times", "tokens", "word", "held_out")}))
    assert got.count() == len(ROWS) and got.where("doc_id IS NULL").count() == 1
    assert operator(table(spark, [])).count() == 0
    assert operator(table(spark, ROWS[:1])).count() == 1
