"""Alignment, decontamination and spelling variants against brute force, with odd rows."""

import gc
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import alignment, catalogue, decontamination, spelling
from sparkloom.llm.catalogue import vocabulary_path
from tests.conftest import canonical, check_against_sql

SCHEMA = "doc_id bigint, text string"
CLASH = ["source", "words", "digest", "found", "id", "n", "groups", "block"]
A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


def with_clashes(df):
    return df.select("*", *[F.lit("z").alias(c) for c in CLASH])


@pytest.mark.parametrize("name", ["op12_decontamination", "op13_spelling"])
def test_query_matches_sql(spark, sf_dir, sql, name):
    check_against_sql(spark, sf_dir, sql, catalogue.queries()[name], catalogue.oracle_sql()[name])


# alignment


def plainly_aligned(rows):
    """Whole texts through both libraries; groups from the common ends, links from overlapping ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    symbols = alignment.byte_symbols()
    spell_b = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    made, totals = [], Counter()
    for key, text in rows:
        a = a_model.encode(" " + (text or ""), add_special_tokens=False)
        a_bytes, b = [bytes(symbols[c] for c in t) for t in a.tokens], b_model.encode(text or "")
        b_bytes = [spell_b(i) for i in b]
        if not text or any(b"".join(x) != (" " + text).encode() for x in (a_bytes, b_bytes)):
            made.append((key, 0, 0, 0, "", []))
            continue
        a_ends, b_ends = list(itertools.accumulate(map(len, a_bytes))), list(itertools.accumulate(map(len, b_bytes)))
        groups, i, j = [], 0, 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            p, q = a_ends.index(cut) + 1, b_ends.index(cut) + 1
            groups.append(",".join(map(str, a.ids[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        links = []
        for x, (s, e) in enumerate(zip([0, *a_ends], a_ends, strict=False)):
            for y, (u, v) in enumerate(zip([0, *b_ends], b_ends, strict=False)):
                if s < v and u < e:
                    links.append((a.ids[x], b[y]))
        totals.update(links)
        made.append((key, len(a.ids), len(b), len(groups), ";".join(groups), links))
    most = defaultdict(int)
    for (_, y), n in totals.items():
        most[y] = max(most[y], n)
    return [(k, na, nb, ng, len(ls), sum(totals[x] == most[x[1]] for x in ls), sum(totals[x] for x in ls), g) for k, na, nb, ng, g, ls in made]


ODD_TEXTS = [
    None, "", " ", "\n", "one two", "one two", "one\ntwo", "  lead", "trail  ", "a \nb\n", "tab\tand\r\nline", "double  space here", "a▁b", "<s> <0x41> <|endoftext|>", "中文 字 \x00 x",
    "é😀 ünï\n\tcode  two", "w" * 700, "don't we'll 12,345.67 (x) [y]; z!", " no break　space", "x\x1cy z\x85q", "१२३ عربى טֶ", "''' \"\"\" ... ,,,", "a" + " b" * 60, " \n a\n\nb \n c", "﻿bom ﬁ ligature",
]


def test_alignment_equals_whole_texts_aligned_plainly(spark):
    rng = random.Random(3)
    pool = ["the", "ción", "été", "x", "12", "»", " ", "  ", "\n", "\n\n", ", ", ".", "'s", "😀", "word", "Tokens", "\t", "-", "中", " "]
    texts = ODD_TEXTS + [" ".join(rng.choices(pool, k=12)) for _ in range(60)] + ["".join(rng.choices(pool, k=25)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(3, "same id"), (3, "same id"), (None, "no id")]
    got = alignment.align(with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(3)), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert canonical(got.collect()) == canonical(plainly_aligned(rows))
    hashed = {r.groups for r in alignment.align(spark.createDataFrame(rows, SCHEMA), A, B, as_text=False).collect()}
    assert hashed == {hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "" for r in plainly_aligned(rows)}
    assert alignment.align(spark.createDataFrame([], SCHEMA), A, B).count() == 0


def test_alignment_over_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("length(text) < 1500")
    rows = [tuple(r) for r in docs.collect()]
    assert canonical(alignment.align(docs, A, B).collect()) == canonical(plainly_aligned(rows))


def test_alignment_lets_go_of_a_block():
    both = alignment.vocabularies(A, B)
    part = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words and more", "some  other words"])], names=["doc_id", "text"])
    alignment.block_of(both, part, False)
    gc.collect()
    gc.disable()
    try:
        held = lambda: sum(isinstance(x, defaultdict) for x in gc.get_objects())
        before = held()
        alignment.block_of(both, part, False)
        assert held() == before
    finally:
        gc.enable()


def test_shared_ends_finds_every_common_end():
    rng = np.random.default_rng(5)
    for _ in range(200):
        borders = np.cumsum(rng.integers(1, 60, 8))
        a = np.union1d(rng.integers(1, borders[-1] + 1, rng.integers(1, 200)), borders)
        b = np.union1d(rng.integers(1, borders[-1] + 1, rng.integers(1, 200)), borders)
        last_a, last_b = np.searchsorted(a, borders), np.searchsorted(b, borders)
        found = alignment.shared_ends(a, b, np.r_[0, last_a[:-1] + 1], last_a, np.r_[0, last_b[:-1] + 1], last_b)
        assert sorted([*found, *borders]) == np.intersect1d(a, b).tolist()


# decontamination


def plainly_hit(docs, items, size=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    windows = defaultdict(set)
    for item, text in items:
        words = split(text)
        k = min(size, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            windows[tuple(words[i : i + k])].add(item)
    out = []
    for key, text in docs:
        words, hit, found = split(text), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(words[i : i + k])]
        out.append((key, len(words), len(hit), sorted(str(x) for x in found if x is not None), bool(hit)))
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(7)
    vocabulary = ["a", "b", "c", "The", "é", "ß", "X1", "٣", "w" * 40]
    text = lambda n: rng.choice([" ", "-", "\n, "]).join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 9, 10, 11, 14]))) for i in range(12)] + [(12, None), (13, "!?"), (14, text(12)), (14, "other words"), (None, "a b c the")]
    items.append((15, items[3][1]))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(60)]
    docs += [(100 + i, f"intro {t} outro {t}") for i, (_, t) in enumerate(items)]
    docs += [(1, docs[1][1]), (1, docs[1][1]), (None, docs[2][1]), (200, None), (201, ""), (202, " . "), (203, " ".join(["long"] * 30000 + [items[0][1]]))]
    table, benchmark = with_clashes(spark.createDataFrame(docs, SCHEMA).repartition(3)), spark.createDataFrame(items, "item_id bigint, text string")
    for size in (10, 4):
        got = decontamination.find_items(table, benchmark, size=size)
        assert got.columns == ["doc_id", "n_words", "n_hit", "items", "contaminated"]
        assert canonical(got.collect()) == canonical(plainly_hit(docs, items, size))
    assert decontamination.find_items(table, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontamination.find_items(table.limit(0), benchmark).count() == 0


def test_decontamination_slices_keep_texts_apart(spark, monkeypatch):
    docs, items = [(i, "alpha beta") for i in range(6)] + [(9, "beta alpha")], [(0, "beta alpha")]
    rows = decontamination.find_items(spark.createDataFrame(docs, SCHEMA).coalesce(1), spark.createDataFrame(items, "item_id bigint, text string")).where("contaminated").collect()
    assert [r.doc_id for r in rows] == [9]


# spelling variants


def plainly_varied(docs, every=31, factor=10):
    counts = Counter()
    for key, text in docs:
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = defaultdict(set)
    shorter = defaultdict(set)
    for w in n:
        for d in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shorter[d].add(w)
    for group in shorter.values():
        for a, b in itertools.permutations(group, 2):
            cut = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            if a[cut + (len(a) >= len(b)) :] == b[cut + (len(b) >= len(a)) :]:
                near[a].add(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_spelling_variants_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    bases = ["".join(rng.choices("abé", k=rng.randrange(7, 11))) for _ in range(40)] + ["aaaaaaa", "aaaaaaaa", "abababab", "ÀÿÀÿÀÿÀ", "x" * 400]
    words = []
    for base in bases:
        words += [base] * rng.choice([2, 20, 300])
        for _ in range(12):
            i, kind = rng.randrange(len(base) + 1), rng.randrange(3)
            words += [base[:i] + rng.choice(["", "a", "z"]) + base[i + (kind > 0) :]] * rng.choice([1, 2, 25])
    rng.shuffle(words)
    docs = [(i % 50 if i % 7 else None, " ".join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    docs += [(1, None), (2, ""), (3, "short ones only"), (4, "Straße×Straße ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷"), (4, "Straße×Straße ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷")]
    table = with_clashes(spark.createDataFrame(docs, SCHEMA).repartition(3))
    for setting in ((3, 5, 100_000, 40), (3, 6, 500, 2), (2, 4, 100_000, 3)):
        monkeypatch.setattr(spelling.near_words, "__defaults__", setting)
        got = spelling.spelling_variants(table)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert canonical(got.collect()) == canonical(plainly_varied(docs))
    assert spelling.spelling_variants(table.limit(0)).count() == 0


@pytest.mark.parametrize("longest", [3, 5, 7])
def test_words_one_edit_apart_share_grams_beyond_the_bound(longest):
    rng = random.Random(longest)
    for _ in range(400):
        letters = rng.choice(["ab", "abcdef"])
        a = "".join(rng.choices(letters, k=rng.randrange(7, 13)))
        i, kind = rng.randrange(len(a)), rng.randrange(3)
        b = a[:i] + (rng.choice(letters) if kind else "") + a[i + (kind < 2) :]
        if a == b or len(b) < 7:
            continue
        pieces = [a[p : p + q] for q in range(3, longest) for p in range(len(a))] + ["<<<", "<<" + a[0], b[-1] + ">>"]
        common = {g: 1 for g in pieces if rng.random() < 0.6}
        (grams_a, least_a), (grams_b, least_b) = (spelling.decompose("<<<" + w + ">>", common, 3, longest) for w in (a, b))
        aligned = {g for g, p in grams_a for h, q in grams_b if g == h and (p == q or p - len(a) == q - len(b))}
        assert len(aligned) >= max(least_a, least_b) and min(least_a, least_b) >= 1
