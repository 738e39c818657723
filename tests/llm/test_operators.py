"""Each training-data operator against a brute-force version or a round trip, with odd rows."""

import hashlib
import itertools
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import ann, catalogue, licences, links, minhash, packing, pages, pii, quality, repeats, subwords
from sparkloom.llm.catalogue import vocabulary_path

ODD = [(1, None), (2, ""), (3, " "), (4, "a b c d e f"), (5, "a b c d e f"), (6, "x" * 3000), (7, "é😀 ünï\n\tcode  two"), (8, "a b"), (8, "a b"), (None, "no id here at all")]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def odd(spark):
    extra = [F.lit("s").alias("source"), F.lit(1).alias("n"), F.lit("z").alias("spans"), F.lit(0).alias("label")]
    return spark.createDataFrame(ODD, SCHEMA).select("*", *extra)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def empty(df):
    return df.limit(0)


def test_subwords_agree_with_the_library(spark, documents, odd):
    import sentencepiece

    path = vocabulary_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    more = spark.createDataFrame([(900 + i, t) for i, t in enumerate(["  a  b ", "a▁b", "a \nb\n", "\n", "中文 字 \x00", "w" * 500, " <s> <0x41>"])], SCHEMA)
    whole = documents.select("doc_id", "text").union(odd.select("doc_id", "text")).union(more)
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in subwords.digests(subwords.encode_decode(whole, path)).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = []
    for r in whole.collect():
        ids = library.encode(r.text or "")
        wanted.append((r.doc_id or 0, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(wanted)
    assert subwords.encode_decode(empty(odd), path).count() == 0


@pytest.mark.parametrize("text", ["one two", "one\ntwo", "one  two"])
def test_subwords_verify_words_line_breaks_and_whole_texts(text, monkeypatch):
    vocabulary = subwords.MergeVocabulary(vocabulary_path("piece_bpe_32k.model"))
    subwords.WordCache(vocabulary).encode([text])
    merge, ids_of = vocabulary.merge, vocabulary.ids_of
    monkeypatch.setattr(vocabulary, "merge", lambda s: [*merge(s), 5])
    monkeypatch.setattr(vocabulary, "ids_of", lambda w: [*ids_of(w), 5] if w[:1] == "\n" else ids_of(w))
    words = subwords.WordCache(vocabulary)
    together = words.lockstep.merge
    monkeypatch.setattr(words.lockstep, "merge", lambda some: [[*(x or []), 5] for x in together(some)] if text == "one two" else together(some))
    with pytest.raises(ValueError):
        words.encode([text])


def test_lockstep_agendas_equal_the_list_and_the_heap():
    words = subwords.WordCache.of(vocabulary_path("piece_bpe_32k.model"))
    rng = np.random.default_rng(8)
    for length in (1, 2, 3, 7, 15, 24):
        some = ["".join(rng.choice(list("▁aeinrsté.中😀-"), length)) for _ in range(200)]
        for word, found in zip(some, words.lockstep.merge(some), strict=True):
            assert words.vocabulary.short(word) == words.vocabulary.long(word)
            assert found is None or found == words.vocabulary.merge(word)


def test_packing_words_against_the_library():
    words = packing.WordIds.of(vocabulary_path("word_bpe_49k.json"))
    rng = np.random.default_rng(9)
    some = list("aÉß., \n3x!µé\u0301İΣ\xad\xa0\x85ª-") + ["  ", "'s", "..", ". ", ", ", "<|", "|>", "<|endoftext|>", "ǅ", "don't"]
    texts = ["".join(rng.choice(some, rng.integers(0, 14))) for _ in range(3000)] + [""]
    end = np.array([2], "<u4").tobytes()
    assert words.direct and words.encode(texts, 2).to_pylist() == [words.whole(t) + end for t in texts]
    assert words.encode([""], 2).to_pylist() == [end]


def test_packing_words_are_parted_and_looked_up_again(monkeypatch):
    """Marks behind letters go to the library once, and words met again stay when half the table goes."""
    words = packing.WordIds(vocabulary_path("word_bpe_49k.json"))
    marks = [a + b for a in "!#$%&()*+,-./:;=>?@[]^_`{|}~" for b in ["", "!", "$$"]]
    texts = [f"{w}{m} x" for w in ("Haus", "été", "straße", "word") for m in [*marks, "<", "'s!", "!'s", "<|endoftext|>", "é", "\u0338!"]]
    want = [words.whole(t) + np.array([2], "<u4").tobytes() for t in texts]
    whole, asked = words.whole, []
    monkeypatch.setattr(words, "whole", lambda text: asked.append(text) or whole(text))
    assert words.encode(texts, 2).to_pylist() == want and words.encode(texts[:50] * 2, 2).to_pylist() == want[:50] * 2
    assert len([a for a in asked if len(a) > 3]) < len(texts) / 4
    monkeypatch.setattr(packing.WordIds, "MOST", 100)
    words.known, words.older = {}, {}
    asked.clear()
    for i in range(40):
        words.encode(["stays0 " + " ".join(f"w{i}a{j}" for j in range(20))], 2)
    assert asked.count("stays0") == 1 and len(words.known) + len(words.older) < 160


def test_packing_covers_every_id_once(spark, documents, odd):
    from tokenizers import Tokenizer

    path = vocabulary_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = documents.select("doc_id", "text", "source").union(odd.where("doc_id < 8").selectExpr("doc_id + 100000", "text", "null"))
    got = packing.pack(docs, path).toPandas()
    for r in docs.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        own = got[got.doc_id == r.doc_id].sort_values("start")
        assert own.start.tolist() == (own.length.cumsum() - own.length).tolist() and own.length.sum() == len(ids)
        assert [zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in own.itertuples()] == own.ids_crc32.tolist()
    laid = got.sort_values(["sequence_id", "offset"])
    assert (laid.offset == laid.groupby("sequence_id").length.cumsum() - laid.length).all()
    sizes = laid.groupby("sequence_id").length.sum()
    assert all(n & (n - 1) == 0 and n <= 4096 for n in sizes)
    full = laid[laid.sequence_id.isin(sizes[sizes == 4096].index)]
    share = full.groupby(["sequence_id", "queue"]).length.sum().unstack(fill_value=0) / 4096
    assert (share.mean() - got.groupby("queue").length.sum() / got.length.sum()).abs().max() < 0.03
    assert packing.pack(empty(docs), path).count() == 0


def test_quality_on_held_out_rows(spark, odd):
    root = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).where("held_out").join(labels, "doc_id").toPandas()
    assert ((got.score >= 0.3) == (got.quality == 1)).mean() >= 0.9
    scored = quality.score(odd, model).toPandas()
    assert len(scored) == len(ODD) and scored.score.between(0, 1).all()
    assert quality.keep(odd, model, 0.0).columns == odd.columns and quality.keep(empty(odd), model, 0.3).count() == 0
    assert quality.fit(docs, empty(labels))[1] == 0.0


def test_quality_reads_whole_long_words(spark):
    han = lambda start, n: "".join(chr(0x4E00 + (start + 7 * i) % 2000) for i in range(n))
    begun = han(0, 70)
    rows = [(i, begun + han(900 + i % 2 * 500, 300)) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality")
    got = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").toPandas()
    assert (got.score > 0.5).tolist() == (got.quality == 1).tolist()
    assert len(quality.word_features("x" * 5000)) == 1 + 5001 + 5000 + 4999


def brute_groups(rows, size, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))} if words else set()
    low = {i: i for i, _ in rows}
    root = lambda i: i if low[i] == i else root(low[i])
    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            low[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("pairwise", [24, 2])
def test_minhash_against_brute_force(spark, documents, odd, monkeypatch, pairwise):
    monkeypatch.setattr(minhash, "PAIRWISE", pairwise)
    base = [f"w{i}" for i in range(120)]
    rng = np.random.default_rng(1)
    near = []
    for i in range(60):  # a group of near copies around the threshold
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 7), replace=False):
            words[at] = f"e{i}_{at}"
        near.append((5000 + i, " ".join(words)))
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()] + [(i + 90000, t) for i, t in ODD[:7]] + near
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), size=4, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, 4, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_odd_rows(odd):
    got = minhash.near_duplicates(odd, size=4, percent=80).toPandas()
    assert len(got) == len(ODD)
    assert got[got.doc_id == 5].component_id.tolist() == [4] and got[got.doc_id.isin([1, 2, 3])].n_shingles.tolist() == [0, 0, 0]
    assert minhash.near_duplicates(empty(odd), size=4).count() == 0


def test_superminhash_estimates_similarity():
    a, b = np.arange(1000, dtype=np.uint64), np.arange(200, 1200, dtype=np.uint64)
    signs = [minhash.superminhash(minhash.mix(x), np.zeros(len(x)), 1, 96)[0] for x in (a, b)]
    assert abs((signs[0] == signs[1]).mean() - 800 / 1200) < 0.15


def test_repeats_against_brute_force(spark):
    rng = np.random.default_rng(2)
    noise = lambda n: "".join(rng.choice(list("abcdefgh é\n"), n))
    passage, edge = noise(700), noise(400)
    texts = [noise(900) + passage + noise(300), passage[:500] + noise(50), noise(10) + passage[150:], edge, "q" + edge, edge[:399], "z" * 900, None, "", noise(450) * 2, noise(2000), passage, passage]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA + ", spans string")
    got = repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == repeats.removed_by_brute_force(texts)
    kept = repeats.without_repeats(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 11").count() == 0 and kept.where("doc_id = 10").count() == 1
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_repeat_stage_takes_passages_of_51_words(spark):
    import corpus_pipeline

    rng = np.random.default_rng(5)
    some = lambda n: [str(w) for w in rng.choice([f"{a}{b}" for a in "abcdefghij" for b in ["", "e", "éla", "irt", "ontou"]], n)]
    texts = []
    for n in (50, 51, 52, 55, 60):  # too short, then passages of 150 to 250 bytes, with other white space in the copy
        passage = some(n)
        texts += [" ".join(some(40) + passage + some(30)), " ".join(some(7)) + "\n" + "\n".join(passage) + " " + " ".join(some(90))]
    short = some(51)
    han = "".join(chr(c) for c in rng.choice(np.arange(0x4E00, 0x5E00), 60))
    texts += [" ".join(short), " ".join(short), "前" + han + "后", "x y " + han[3:], " ".join(some(300)), "", "one two"]
    docs = spark.createDataFrame([(i, t, "l", "s", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in corpus_pipeline.repeat_stage(spark, docs, "").collect()}
    left = repeats.words_left_by_brute_force(texts, 51)
    assert sum(len(x) for x in left) < sum(len(repeats.Words.WORD.findall(t)) for t in texts) - 2 * (51 + 52 + 55 + 60)
    for i, words in enumerate(left):
        assert (i in got) == (bool(words) or not texts[i])
        if i in got:
            assert repeats.Words.WORD.findall(got[i].text) == words and got[i].n_chars == len(got[i].text)


def test_repeats_count_words_of_short_passages(spark):
    """Passages of 51 words and more whose bytes are too few to be removed are counted, and those of 50 aren't."""
    rng = np.random.default_rng(9)
    some = lambda n: [str(w) for w in rng.choice([f"{a}{b}" for a in "abcdefghij" for b in ["", "e", "éla", "irt", "ontou"]], n)]
    texts = []
    for n in (50, 51, 52, 60, 94, 200):
        passage = some(n)
        texts += [" ".join(some(40) + passage + some(30)), "\t" + " ".join(some(7)) + "\n" + "\x0b".join(passage) + "  " + " ".join(some(90)) + " "]
    short, line = ["a"] * 51, some(7)
    edge = some(51)
    texts += [" ".join(short), "b " + " ".join(short[:50]), " ".join(line * 40), "x " + " ".join(line * 30), " ".join(edge), "x" + " ".join(edge), " ".join(edge) + "x"]
    texts += [" ".join(some(3000)), "w" * 900, "\u3000".join(some(60)), None, "", " \n", "one two", *[" ".join(some(20) + edge[:30])] * 2, *[" ".join(some(70))] * 2]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA + ", spans string").repartition(3)
    got = repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256), "n_repeated_words").orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == repeats.removed_by_brute_force(texts)
    word = re.compile(r"[^\x20\x09-\x0D]+")
    left = repeats.words_left_by_brute_force([t or "" for t in texts], 51, word)
    assert [r.n_repeated_words for r in got] == [len(word.findall(t or "")) - len(x) for t, x in zip(texts, left, strict=True)]
    assert [r.n_repeated_words for r in got[:8]] == [0, 0, 51, 51, 52, 52, 60, 60] and not any(r.n_removed for r in got[2:8])


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def fits(kind, found):
    d = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def test_pii_against_plain_patterns(spark, documents, odd):
    model = pii.train(spark)
    cases = ["a@b.c@d.e x%d@e.f.g", "1.1.1.1.1.1 300.1.1.1 001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (555) 123-4567 +1+2", "é😀 a@b.co, 10.0.0.1", "1.2." * 2000, "9" * 5000, "a." * 9000 + "b@c" + ".d" * 9000]
    whole = documents.select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(cases)], SCHEMA)).union(odd.select("doc_id", "text").where("doc_id < 4"))
    got = pii.digests(pii.find_spans(whole, model=model)).collect()
    wanted = []
    for r in whole.collect():
        text = r.text or ""
        spans = sorted((m.start(), i, m.end(), k) for i, k in enumerate(PLAIN) for m in re.finditer(PLAIN[k], text) if fits(k, m.group()))
        wanted.append((r.doc_id, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()))
    assert sorted((r.doc_id, r.base_sha256) for r in got) == sorted(wanted)
    more = spark.createDataFrame([(1, "call (020) 555-1234, not on 12-10-2024"), (2, None), (3, "x a@b.co y 10.0.0.1")], SCHEMA + "").withColumn("spans", F.lit(1))
    clean = {r.doc_id: r.text for r in pii.redact(more, model=model).collect()}
    assert clean[2] is None and clean[3] == "x [EMAIL] y [IP]" and "555" not in clean[1]
    assert pii.find_spans(empty(odd), model=model).count() == 0


def test_pii_many_spans_in_one_text_and_overlaps(spark):
    import time

    model = pii.train(spark)
    text = " ".join(f"a{i}@b.co call (020) 555-{i % 10000:04d}, 10.0.{i % 200}.7" for i in range(7000))
    rows = [(1, text), (2, "card 4111 1111 1111 1112 and card 4111 1111 1111 1111"), (3, "+1 (017) 555-7713 call (017) 555-7713"), (4, "the order no 4111 1111 1111 1112")]
    docs = spark.createDataFrame(rows, SCHEMA)
    began = time.time()
    got = {r.doc_id: r for r in pii.digests(pii.find_spans(docs, model=model)).collect()}
    assert time.time() - began < 60
    assert got[1].n_email == got[1].n_ip == 7000 and len(got[1].spans.split(",")) == 21000
    assert got[2].spans == "card_like:5:24,card:34:53" and got[4].spans == ""
    assert got[3].spans == "phone:0:17,phone_local:23:37"
    clean = {r.doc_id: r.text for r in pii.redact(docs, model=model).collect()}
    assert clean[2] == "card [CARD_LIKE] and card [CARD]" and clean[3] == "[PHONE] call [PHONE_LOCAL]" and clean[1].count("[IP]") == 7000


def test_pii_plan_holds_each_feature_once(spark):
    """The driver keeps, optimizes and logs the plan, which named the inputs anew at each node of the trees."""
    model = pii.train(spark, n=1500)
    docs = spark.createDataFrame([(1, "call (020) 555-1234")], SCHEMA)
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        plan = pii.redact(docs, model=model)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert sum(map(len, model[0])) > 100 and 0 < plan.count("call|phone") <= 2 and len(plan) < 100_000


def test_pii_held_out_precision(spark):
    trees, x, y = pii.fitted(spark, pii.EXAMPLES)
    margins = np.array([sum(pii.value(t, row) for t in trees) for row in x])
    cut = pii.smallest_cut(margins, y, pii.PRECISION)
    taken = margins >= cut
    assert np.isfinite(cut) and y[taken].mean() >= pii.PRECISION and y[taken].sum() / y.sum() > 0.3
    assert 0.05 < y[margins >= 0].mean() < 1  # neither format nor context tells all


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("label", F.lit(0))


def test_vector_operators(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 16))
    x[100:160] = x[0] + rng.normal(size=(60, 16)) * 0.05
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    bad = [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] + [1.0] * 15), (2300, [None] + [1.0] * 15)]
    same = [(3000, rows[5][1]), (3001, rows[5][1])]
    df = vectors(spark, rows + bad + same)
    data = np.array([r[1] for r in rows + same], np.float32).astype(float)
    ids = np.array([r[0] for r in rows + same])
    got = ann.search(df, df.where("vec_id % 100 = 0")).toPandas()
    hits = 0
    for q in [i for i in ids if i % 100 == 0]:
        apart = np.sqrt(((data - data[ids == q][0]) ** 2).sum(1))
        apart[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, apart))[:10]]) & set(got[got.query_id == q].vec_id))
    assert hits / (10 * len(set(got.query_id))) >= 0.9 and not set(got.query_id) & {2000, 2100, 2200, 2300}
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = links.near_duplicates(df).toPandas().set_index("vec_id")
    assert found.loc[ids].n_links.tolist() == near.sum(1).tolist()
    assert found.loc[3001].component_id == 5 and found.loc[[b[0] for b in bad]].n_links.sum() == 0 and len(found) == len(rows) + 6
    assert ann.search(df.limit(0), df.limit(0)).count() == 0 and links.near_duplicates(df.limit(0)).count() == 0


class Blind(links.Graph):
    """A graph whose search finds nothing."""

    def search(self, queries, width):
        ids, score = super().search(queries, width)
        return np.full_like(ids, -1), score


class Still(links.Graph):
    """A graph that can't be searched from its entry."""

    def search(self, queries, width):
        raise AssertionError("a node's own links are looked for from its place")


def test_own_links_need_no_beam():
    rng = np.random.default_rng(8)
    x = np.repeat(rng.normal(size=(300, 32)), 5, axis=0) + rng.normal(size=(1500, 32)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = links.linked(Still(x), x, 0.9, own=True)
    assert [sorted(row) for row in got] == [np.flatnonzero(row).tolist() for row in x @ x.T >= 0.9]


def test_vector_links_that_the_graph_misses():
    rng = np.random.default_rng(6)
    x, other = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.normal(size=(2, 900, 16)))
    rare = other.copy()
    rare[[3, 700]] = x[[650, 20]]  # two links in all: hardly any audit meets one
    common = np.concatenate([x[:450], x[:450]]) + rng.normal(size=(900, 16)) * 0.01  # each query has links; none found at any width
    common /= np.linalg.norm(common, axis=1, keepdims=True)
    for queries, own in ((rare, False), (common, False), (x, True)):
        got = links.linked(Blind(x), queries, 0.9, own=own)
        assert [sorted(row) for row in got] == [np.flatnonzero(row).tolist() for row in queries @ x.T >= 0.9]


def test_pages(spark):
    body = "<p>First &amp; long paragraph of the story, with words.</p><ul><li>item one of list</li></ul><p>Second<br>part of it, quite long too."
    page = lambda i: f"<html><body><nav><a href='/'>Home</a></nav><div class='cookie-notice'>We use cookies</div><div class='post{i}'><h1>Title {i}</h1>{body}</div><div class='comments'><p>A reader says something long enough here.</p></div><footer>Foot</footer></body></html>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(3)] + [(8, "http://h.example/8", None), (9, None, "plain <b>text</b>")]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    wanted = "Title {}\n\nFirst & long paragraph of the story, with words.\n\nitem one of list\n\nSecond part of it, quite long too."
    assert [got[i] for i in range(3)] == [wanted.format(i) for i in range(3)] and got[8] == "" and len(got) == 5


class ArticleText(HTMLParser):
    """Blocks of text inside ``article``, read by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in pages.BLOCKS:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in pages.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_pages_against_a_plain_parser(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in pages.extract(table).collect()}
    wanted = {}
    for r in table.collect():
        parser = ArticleText()
        parser.feed(r.html or "")
        parser.close()
        wanted[r.page_id] = "\n\n".join(" ".join(b.split()) for b in parser.blocks if b.strip())
    assert len(got) == len(wanted) and got == wanted


def test_odd_pages(spark):
    import time

    story = "<p>some words that are long enough to count here</p>"
    odd = {
        1: "<body>" + story + "<a " + " ".join(f'a{i}="x" b="' for i in range(1000)),
        2: "<body>" + story + "<a " * 100_000,
        3: "<div>" * 20_000 + story,
        4: "<!" * 100_000,
        5: '<body><p title="a hidden gem">A</p>' + story,
        6: '<body><div aria-hidden="false"><p>B</p></div>' + story,
        7: '<body><p data-id="menu">C</p>' + story,
        8: '<body><section class="search-results-study">D</section>' + story,
        9: '<body><div class="side menu">E</div>' + story,
    }
    rows = [(i, f"http://h{i}/", t) for i, t in odd.items()] + [(1, "http://h1/", odd[1])]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("key", F.lit(1)).withColumn("votes", F.lit("x"))
    began = time.time()
    got = pages.extract(table).collect()
    assert time.time() - began < 60 and len(got) == 10
    begins = {r.page_id: r.text[:4] for r in got}
    assert begins == {1: "some", 2: "some", 3: "some", 4: "", 5: "A\n\ns", 6: "B\n\ns", 7: "C\n\ns", 8: "D\n\ns", 9: "some"}
    assert pages.extract(table.limit(0)).count() == 0


def test_pages_of_a_host_with_many_layouts(spark):
    teaser = "<div class='tease'><p>A teaser that stands on many pages of this host.</p></div>"
    story = lambda k, i: f"<p>Story {i} of layout {k} has a long paragraph with many words in it.</p><p>Its second paragraph is long as well, and ends number {i}.</p>"
    kinds = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"]
    rows, wanted = [], {}
    for n, k in enumerate(kinds):
        for i in range(9 - n):
            rows.append((100 * n + i, "http://h.example/x", f"<html><body>{teaser}<div class='{k}'>{story(k, i)}</div></body></html>"))
            wanted[100 * n + i] = f"Story {i} of layout {k} has a long paragraph with many words in it.\n\nIts second paragraph is long as well, and ends number {i}."
    rows += [(1000 + i, "http://h.example/y", f"<html><body><p>Only the body holds this text of some length, number {i}.</p></body></html>") for i in range(12)]
    rows += [(2000 + i, "http://h.example/z", f"<html><body>{teaser}</body></html>") for i in range(12)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {i: got[i] for i in wanted} == wanted
    assert got[1003] == "Only the body holds this text of some length, number 3." and got[2000].startswith("A teaser") and len(got) == len(rows)


def test_licences(spark, odd):
    rows = [(1, "Prose.\nReleased under the MIT License.\nMore."), (2, "licensed under the apache license version 2.0"), (3, "The licence of a poet."), (4, None)]
    got = {r.doc_id: r.licences for r in licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "MIT", 2: "Apache-2.0", 3: "", 4: ""}
    assert licences.scan(odd).count() == len(ODD)


def test_licences_inside_lines_wrapped_and_whole(spark):
    full = dict(licences.full_texts())
    prose = "Here the story of a long walk goes on with many other words, and so it went for days"
    rows = {
        1: (f"{prose}. Released under the MIT License. {prose}.", "MIT", 1),
        2: (f"{prose}\nThis Source Code Form is subject to\nthe terms of the Mozilla Public\nLicense, v. 2.0. {prose}", "MPL-2.0", 1),
        3: (f"{prose}\n\nCopyright (c) 2020 A. Nother\n\n{full['MIT']}\n{prose}", "MIT", 1),
        4: (f"Copyright 1999\n\n{full['BSD-3-Clause']}", "BSD-3-Clause", 1),
        5: (full["BSD-2-Clause"], "BSD-2-Clause", 1),
        6: (full["GPL-2.0"], "GPL-2.0", 1),
        7: (f"{prose} licensed under CC BY-NC 4.0. {prose} Licensed under the Apache License, Version 2.0. {prose}", "Apache-2.0,CC-BY-NC-4.0", 2),
        8: ("Licensed under CC BY-SA 4.0. Licensed under CC BY 3.0.", "CC-BY-3.0,CC-BY-SA-4.0", 2),
        9: ("Released under the MIT License.\n" * 40, "MIT", 40),
        10: (f"{prose}. " * 50, "", 0),
    }
    got = licences.scan(spark.createDataFrame([(i, t) for i, (t, _, _) in rows.items()], SCHEMA)).collect()
    assert {r.doc_id: (r.licences, r.n_notices) for r in got} == {i: (names, n) for i, (_, names, n) in rows.items()}
    assert all(r.best == 1.0 for r in got if r.doc_id < 10)


def test_licence_windows_against_brute_force():
    rng = np.random.default_rng(4)
    templates = [("a", "one two three four five six two three"), ("b", "three four five"), ("c", "six one two one two one")]
    matcher = licences.Matcher(templates)
    for _ in range(300):
        words = rng.choice(["one", "two", "three", "four", "five", "six", "x"], rng.integers(0, 30)).tolist()
        best = 0.0
        for _, t in templates:
            own = licences.bigrams(t)
            for i in range(len(words)):
                for j in range(i + 2, len(words) + 1):
                    grams = licences.bigrams(" ".join(words[i:j]))
                    best = max(best, 2 * (own & grams).total() / (own.total() + grams.total()))
        found = matcher.notices(" ".join(words))
        assert bool(found) == (best >= 0.8) and all(0.8 <= d <= best for d, _ in found)


def greedy_notices(words: list[str], templates, least: float) -> list[tuple[float, str]]:
    """Windows of all starts and ends, the one of most worth first, until none is left."""
    grams = list(zip(words, words[1:], strict=False))
    own = [(name, licences.bigrams(t)) for name, t in templates]
    free, found = [True] * len(words), []
    while True:
        best = None
        for k, (_, template) in enumerate(own):
            total = template.total()
            for i, first in enumerate(grams):
                left, hits = template.copy(), 0
                if first not in template:
                    continue
                for j in range(i, len(grams)):
                    if not (free[j] and free[j + 1]):
                        break
                    if left[grams[j]] > 0:
                        left[grams[j]] -= 1
                        hits += 1
                    size = j - i + 1
                    dice = 2 * hits / (size + total)
                    if grams[j] in template and dice >= least and (best is None or (size - 2 * hits, -dice, k, i) < best[0]):
                        best = (size - 2 * hits, -dice, k, i), j
        if best is None:
            return found
        (_, dice, k, i), j = best
        free[i : j + 2] = [False] * (j + 2 - i)
        found.append((-dice, own[k][0]))


@pytest.mark.parametrize("short", [0, 64])
def test_licence_notices_equal_a_greedy_search(monkeypatch, short):
    monkeypatch.setattr(licences, "SHORT", short)
    rng = np.random.default_rng(short)
    vocabulary = [f"w{i}" for i in range(9)]
    templates = [(n, " ".join(rng.choice(vocabulary, size))) for n, size in (("a", 24), ("b", 24), ("c", 11), ("d", 40))]
    templates.append(("e", templates[0][1] + " w1 w2"))
    matcher = licences.Matcher(templates)
    some = 0
    for _ in range(60):
        words: list[str] = []
        for _ in range(rng.integers(1, 5)):
            piece = templates[rng.integers(len(templates))][1].split()
            changed = rng.random(len(piece)) < rng.choice([0, 0.04, 0.1])
            words += [rng.choice(vocabulary) if c else w for w, c in zip(piece, changed, strict=True)][rng.integers(0, 3) :]
            words += ["x"] * rng.integers(0, 3)
        expected = greedy_notices(words, templates, 0.8)
        some += len(expected)
        assert matcher.notices(" ".join(words)) == expected
    assert some > 60


def test_licences_many_in_one_document_and_odd_tables(spark):
    full = dict(licences.full_texts())
    many = spark.createDataFrame([(1, full["GPL-3.0"] * 16, 1), (1, full["GPL-3.0"] * 16, 2), (2, "Released under the MIT License. " * 3000, 3), (None, "Released under the MIT License.", 4)], "doc_id long, text string, best int")
    got = sorted((tuple(r) for r in licences.scan(many).collect()), key=str)
    assert got == [(1, 16, "GPL-3.0", 1.0)] * 2 + [(2, 3000, "MIT", 1.0), (None, 1, "MIT", 1.0)]
    assert licences.scan(many.where("doc_id > 5")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = docs.checkpoint()
    assert docs.count() > 0


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_queries_with_sql(spark, sf_dir, sql, name):
    from tests.conftest import check_against_sql

    check_against_sql(spark, sf_dir, sql, catalogue.queries()[name], catalogue.oracle_sql()[name])


def test_minhash_keeps_links_of_rows_that_share_an_id(spark):
    words = lambda k: " ".join(f"w{k}_{i}" for i in range(60))
    rows = [(1, words("a")), (1, words("b")), (2, words("a") + " x"), (3, words("b") + " y"), (4, words("c"))]
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), size=4).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_search_with_few_candidates_and_ties(spark):
    rows = [(i, [1.0, float(i % 3)]) for i in range(8)] + [(500, [1.0]), (501, [2.0])]
    table = vectors(spark, rows).withColumn("id", F.lit(1)).withColumn("leaf", F.lit("x"))
    got = ann.search(table, table.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(1, 3, 0.0), (2, 6, 0.0), (3, 1, 1.0), (4, 4, 1.0), (5, 7, 1.0), (6, 2, 2.0), (7, 5, 2.0)]


def test_links_grow_with_a_group_not_with_its_square(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=8)
    rows = [(i, [float(v) for v in base + rng.normal(size=8) * 0.02]) for i in range(400)] + [(1000 + i, rows) for i, rows in enumerate([[1.0] * 3, [2.0] * 3, None])]
    table = vectors(spark, rows).withColumn("v", F.lit(1)).withColumn("shard", F.lit("x"))
    got = links.near_duplicates(table).toPandas().set_index("vec_id")
    assert (got.loc[range(400)].n_links == 399).all() and (got.loc[range(400)].component_id == 0).all()
    assert got.loc[1001].component_id == 1000 and got.loc[1002].n_links == 0


def test_stored_graphs_are_restored():
    x = np.random.default_rng(13).normal(size=(700, 8))
    graph = links.Graph(x)
    again = links.Graph.restored(x, graph.stored())
    assert len(graph.layers) == len(again.layers)
    assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(graph.layers, again.layers, strict=True))


def test_names_of_elements_are_read_as_wholes(spark):
    story = "<p>some words that are long enough to count here</p>"
    odd = {
        1: f'<body><div class="content no-sidebar">{story}</div>',
        2: f'<body><article>{story}<div class="ad-hoc-networks"><p>Ad hoc.</p></div><section id="header-files"><p>Files.</p></section></article>',
        3: f'<body><article>{story}<div class="site-header">X</div><div id="sidebar-left">Y</div><div class="ad-slot-3">Z</div><div class="comment-list">Q</div></article>',
        4: f"<body><article>{story}<p>Sub <button>Subscribe <b>now</b> or <b>later</b></button>Pick <select><option>a<option>b</select>one</p><dialog>We use cookies</dialog><menu><li>Save</li></menu><p>End</p></article>",
        5: f'<body><article>{story}<p>Before <a class="advert" href="/x">Buy <a>this</a> or <i>that</i></a><ins class="ads">Buy</ins>after <a class="header-link">link</a>.</p></article>',
        6: f'<body><article>{story}<img alt="5" screen"><p>lost text here</p><p title=\'a > "b\'>kept "too".</p></article>',
        7: f'<body><div class="page-with-sidebar is-header">{story}</div>',
    }
    rows = [(i, f"http://h{i}/", t) for i, t in odd.items()]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    first = "some words that are long enough to count here"
    assert got[1] == got[3] == got[7] == first
    assert got[2] == f"{first}\n\nAd hoc.\n\nFiles." and got[4] == f"{first}\n\nSub Pick one\n\nEnd"
    assert got[5].startswith(f"{first}\n\nBefore ") and got[5].endswith("after link.") and "Buy" not in got[5]
    assert got[6] == f'{first}\n\nlost text here\n\nkept "too".'


def test_vectors_that_share_an_id(spark):
    rng = np.random.default_rng(21)
    a, b, c = (rng.normal(size=8) for _ in range(3))
    given = [(5, a), (5, b), (-7, a * 2), (6, b * 3), (6, b * 3), (9, c)]
    rows = [(i, [float(x) for x in v]) for i, v in given]
    got = sorted(tuple(r) for r in links.near_duplicates(vectors(spark, rows)).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == [(-7, 1, -7, True), (5, 1, -7, False), (5, 2, 5, True), (6, 2, 5, False), (6, 2, 5, False), (9, 0, 9, True)]


def test_searches_with_repeated_queries_and_ids(spark):
    rng = np.random.default_rng(22)
    x = rng.normal(size=(300, 4)).astype(np.float32).astype(float)
    rows = [(0, list(x[0]))] * 40 + [(100, list(x[1])), (100, list(x[2]))] + [(i + 1000, list(v)) for i, v in enumerate(x)] + [(200, [1.0, 2.0]), (201, [1.0, 3.0]), (202, [9.0, 3.0])]
    table = vectors(spark, [(i, [float(c) for c in v]) for i, v in rows])
    got = ann.search(table, table.where("vec_id % 100 = 0 AND vec_id < 1000"), recall=1.0).collect()
    want = []
    for query, v in {(i, tuple(v)) for i, v in rows if i % 100 == 0 and i < 1000}:
        near = sorted((float(np.sqrt(((np.array(w) - v) ** 2).sum())), i) for i, w in rows if i != query and len(w) == len(v))[:10]
        want += [(query, rank + 1, i, s) for rank, (s, i) in enumerate(near)]
    assert [r[:3] for r in sorted(tuple(r) for r in got)] == [w[:3] for w in sorted(want)]
    assert len(got) == 32


def test_quality_features_reach_the_driver_small_and_whole(spark, documents):
    rows = documents.select("doc_id", "text", F.lit(1).alias("label")).limit(300).union(spark.createDataFrame([(-1, None, 0), (-2, "", 1), (-3, "a a a b", 0)], "doc_id bigint, text string, label int"))
    starts, ids, weights, labels = quality.sample_features(rows, "text", "label")
    assert labels.tolist() == [r.label for r in rows.collect()] and starts[-1] == len(ids) == len(weights)
    size = 0
    for i, r in enumerate(rows.collect()):
        words, again = quality.words_of(r.text)
        found, counts = np.unique([b for w in words + [quality.AGAIN] * again for b in quality.word_features(w)], return_counts=True)
        own = slice(starts[i], starts[i + 1])
        assert ids[own].tolist() == found.tolist() and np.array_equal(weights[own], (counts / max(1, counts.sum())).astype("<f4"))
        size += len(quality.packed(found, counts))
    assert size < 4 * len(ids)
