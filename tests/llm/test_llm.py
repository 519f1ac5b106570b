"""The training-data operators against brute force, libraries and held-out labels, with edge cases."""

import base64
import gzip
import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from umitally.llm import chat, components, exact_dedup, jaccard, language, merkle, packing, pieces, quality, queries, setsketch, simhash, toxicity, warc
from umitally.llm.common import shared_dir

SF = "/root/testdata/sf0.01"
PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
EDGE = [(1, "a b c d e f", "en"), (2, None, None), (3, "", "en"), (4, " \t\n", "de"), (5, "ab cdef", "en"), (5, "ab cdef", "en"), (None, "a  b c d e f", "en"), (6, "A b c d e f", "en"), (7, LONG, "en"), (8, LONG + " tail", None), (9, "é漢🙂", "fr"), (10, "a b c d e f", "en")]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls everywhere, ties, repeated rows, a very long text and columns whose names clash with results."""
    return docs_of(spark, EDGE).withColumns({"score": F.lit("x"), "kept": F.lit(1), "sid": F.lit(2), "n": F.lit(3), "lang_pred": F.lit("zz")})


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, []).withColumn("score", F.lit(1))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def texts_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


# 1 toxicity


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    n = int(np.sum(y))
    return (rank[np.array(y) == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.predict(docs, marks, locate=True).collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert bool(r.offending) <= (r.predicted == 1)
    y = {r.doc_id: r.toxic for r in marks.collect()}
    out = [i for i in y if got[i].held_out]
    assert auc([got[i].score for i in out], [y[i] for i in out]) > 0.93
    assert np.mean([got[i].predicted for i in out if y[i]]) > 0.8 and np.mean([got[i].predicted for i in out if not y[i]]) < 0.01
    text = texts_of(docs)
    spans = [(text[i], s) for i, r in got.items() for s in r.offending]
    assert spans and all(t[s.start : s.end] == s.sentence for t, s in spans)


def test_noisy_or():
    model = toxicity.SentenceModel(np.zeros(1 << toxicity.BITS, np.float32), -1.0)
    cached = model.cache()
    p = 1 / (1 + np.exp(1.0))
    words = " ".join("w" * 3 for _ in range(toxicity.BLOCK))
    assert abs(model.score(f"{words}. {words}! {words}", cached) - (1 - (1 - p) ** 3)) < 1e-9
    assert model.score("...", cached) == 0.0 and len(model.sentences("a. b. c.", cached)) == 1


def test_toxicity_sample():
    assert toxicity.SAMPLE >= 6000


def plain_instances(text):
    """Lists of words: sentences, of which those that begin in one block of eight words are one."""
    out, block, fresh, k = [], None, True, 0
    for tok in re.findall(r"[^\W_]+(?:'[^\W_]+)*|[.!?\n]+", text.lower()):
        if tok[0] in ".!?\n":
            fresh = True
            continue
        if fresh and k // 8 != block:
            out.append([])
            block = k // 8
        fresh = False
        out[-1].append(tok)
        k += 1
    return out


def test_toxicity_equals_plain_noisy_or(spark, documents, labels):
    """The whole result against a loop over sentences and words, with the model's weights."""
    model = toxicity.fit(documents, labels)
    got = {r.doc_id: r for r in toxicity.predict(documents, labels, locate=True).collect()}
    weight = {}
    for i, text in texts_of(documents).items():
        clean, ps = 1.0, []
        for words in plain_instances(text or ""):
            z = model.bias
            for w in words:
                if w not in weight:
                    weight[w] = sum(float(model.weights[toxicity.buckets([f])[0]]) for f in [w, *(w[:n] + "*" for n in (4, 5, 6, 7) if len(w) >= n)])
                z += weight[w]
            ps.append(1 / (1 + np.exp(-np.clip(z, -40, 40))))
            clean *= 1 - min(ps[-1], 1 - 1e-12)
        assert abs(got[i].score - (1 - clean)) < 1e-6 and got[i].predicted == (got[i].score >= 0.7)
        # What is located are the instances that were scored.
        want = sorted(p for p in ps if p >= 0.5) or sorted(ps)[-1:]
        assert np.allclose(sorted(s.p for s in got[i].offending), want if got[i].predicted else [], atol=1e-6)
    assert sum(r.predicted for r in got.values()) > 5


def test_locate_names_the_likeliest():
    weights = np.zeros(1 << toxicity.BITS, np.float32)
    weights[toxicity.buckets(["bad"])] = 0.4
    model = toxicity.SentenceModel(weights, -0.5)
    cached = model.cache()
    plain, worse = " ".join(["w"] * 9) + ".", " ".join(["w"] * 8) + " bad."
    text = f"{plain} {worse} {plain}"
    assert model.score(text, cached) >= toxicity.THRESHOLD
    (a, b, p), = model.locate(text, cached)
    assert text[a:b].strip() == worse and 0.47 < p < 0.5 and model.locate("...", cached) == []


def test_toxicity_query_locates(spark):
    got = queries.op1_toxicity(spark, SF).where("predicted = 1").collect()
    assert got and all(r.offending for r in got)


def test_toxicity_edges(edge, empty, labels):
    none = labels.where("false")
    assert toxicity.predict(edge, none).count() == len(EDGE)
    assert {r.score for r in toxicity.predict(edge, none).collect()} == {0.0}
    assert toxicity.predict(empty, none).count() == 0
    scored = {r.doc_id: r for r in toxicity.predict(edge, labels.limit(0).unionByName(labels.where("doc_id < 20"))).collect()}
    assert scored[2].score == scored[3].score == 0.0 and scored[None].held_out is False


# 2 pieces


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_equal_library(spark, documents, library):
    got = {r.doc_id: r for r in pieces.encode_decode(documents, PIECES).collect()}
    for i, t in texts_of(documents).items():
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want


def test_pieces_odd_texts(library):
    rng = random.Random(1)
    parts = ["a", "the ", "ing", " ", "    ", "▁", "é", "\n", "\t", "12", "<s>", "<0x41>", "🙂", "漢", "\x00", "====", "--", "​", "𝔘", "�", "s" * 9]
    texts = ["", " ", " " * 99, "a" * 999, "=" * 333, "▁▁ ", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 50))) for _ in range(2000))]
    m = pieces.PieceModel(PIECES)
    for t, b in zip(texts, m.encode_bytes(texts), strict=True):
        ids = np.frombuffer(b, "<u4").tolist()
        assert ids == library.encode(t, add_bos=True, add_eos=True)
        assert m.decode(ids) == library.decode(ids)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(0, 7))]
        assert m.decode(ids) == library.decode(ids)


def test_pieces_edges(edge, empty):
    rows = pieces.encode_decode(edge, PIECES, with_ids=True).collect()
    assert len(rows) == len(EDGE) and {tuple(r.ids) for r in rows if r.doc_id in (2, 3)} == {(1, 2)}
    assert pieces.encode_decode(empty, PIECES).count() == 0


# 3 packing


def check_pieces(rows, texts, window=packing.WINDOW):
    """Each id in exactly one piece, gapless sequences of at most a window."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, ps in by_doc.items():
        at = 0
        for r in sorted(ps, key=lambda r: r.start):
            part = ids[i][at : at + r.length]
            assert r.start == at and len(part) == r.length > 0 and r.doc_tokens == len(ids[i]) and r.ids_crc32 == zlib.crc32(part.astype("<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    for ps in by_seq.values():
        at = 0
        for r in sorted(ps, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return sum(map(len, ids.values())) / (len(by_seq) * window)


def test_packing(documents):
    docs = documents.repartition(3)
    assert check_pieces(packing.pack_words(docs, WORDS).collect(), texts_of(documents)) > 0.98
    assert check_pieces(packing.pack_words(docs, WORDS, window=64, keep=4).collect(), texts_of(documents), 64) > 0.95


def test_packing_edges(spark, edge, empty):
    one_each = {i: t for i, t, _ in EDGE if i not in (5,)}
    check_pieces(packing.pack_words(edge.where("doc_id <> 5 OR doc_id IS NULL"), WORDS).collect(), one_each)
    assert packing.pack_words(edge.where("doc_id = 5"), WORDS).count() == 2
    assert packing.pack_words(empty, WORDS).count() == 0


def test_words_equal_library():
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORDS)
    lib.encode_special_tokens = True
    rng = random.Random(2)
    parts = ["a", "'s", "'T", "é", "ß", "\n", " ", "12", "½", "²", "<|endoftext|>", "漢", "İ", "Σ", "ς", "́", "\xa0", " ", "—", "$$", "_", "ª", "ǅ", "\x85", "\x1c", "\xad"]
    texts = ["", " ", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(3000))]
    own = packing.WordTokenizer(WORDS)
    for t, b, e in zip(texts, own.encode_bytes(texts), lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(b, "<u4").tolist() == e.ids, t


def test_packing_equals_unmodified_library(spark):
    """Texts with added tokens, in any case and before a combining sign, as the library encodes them by default."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORDS)
    rng = random.Random(3)
    parts = ["a", "the end ", " ", "12", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|StartOfText|>", "<|endoftext", "|>", "\u0338", "é", "\n", "漢"]
    texts = ["<|endoftext|>", "x<|startoftext|>y", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 8))) for _ in range(3000))]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [49407]
    for t, b, ids in zip(texts, packing.tokenizer(WORDS).encode_bytes(texts), want, strict=True):
        assert np.frombuffer(b, "<u4").tolist() == ids, t
    got = packing.pack_words(docs_of(spark, [(k, t, "en") for k, t in enumerate(texts[:50])]), WORDS).collect()
    assert {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in got} == {k: (len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes())) for k, ids in enumerate(want[:50])}


# 4 quality and 5 language


def test_quality_held_out(documents, labels):
    got = {r.doc_id: r for r in quality.predict(documents, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    y = {r.doc_id: r.quality for r in labels.collect()}
    out = [i for i in y if got[i].held_out]
    assert len(got) == 1000 and auc([got[i].score for i in out], [y[i] for i in out]) > 0.95


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    fm = quality.FactorisationMachine(0.3, rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, quality.RANK)))
    ids, x = np.array([1, 5, 9, 2, 7]), np.array([0.5, 1.0, -1.0, 2.0, 0.1])
    pair = lambda a, b: sum(fm.factors[ids[i]] @ fm.factors[ids[j]] * x[i] * x[j] for i in range(a, b) for j in range(i + 1, b))
    want = [0.3 + (fm.linear[ids[a:b]] * x[a:b]).sum() + pair(a, b) for a, b in ((0, 3), (3, 5))]
    assert np.allclose(fm.logits(ids, x, np.array([0, 3])), want)


def test_quality_equals_plain_pairs(documents, labels):
    """The whole result against the sum over pairs of features, on texts of at most 150 words."""
    model = quality.fit(documents, labels)
    docs = documents.where("size(split(text, ' ')) <= 150")
    rows = {r.doc_id: r for r in docs.collect()}
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(rows) > 100
    for i, r in rows.items():
        ids, x, _ = quality.vectors([r.text], [r.n_chars], quality._Cached())
        z = model.bias + sum(float(model.linear[a]) * v for a, v in zip(ids, x, strict=True))
        dots = (model.factors[ids] @ model.factors[ids].T).astype(float)
        z += sum(dots[a, b] * x[a] * x[b] for a in range(len(ids)) for b in range(a + 1, len(ids)))
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-4


def test_language_equals_plain_windows(documents):
    """The whole result against one window, filter and place at a time."""
    docs = documents.where("length(text) <= 700")
    net = language.fit(documents)
    texts = dict(sorted(texts_of(docs).items())[:25])
    got = {r.doc_id: r for r in language.identify(docs.where(F.col("doc_id").isin(list(texts))), net).collect()}
    for i, text in texts.items():
        total, weight = np.zeros(len(net.languages)), 0
        data = [int(language.CLASS_OF[b]) for b in text.lower().encode()]
        for at in range(0, max(1, len(data) - 3), language.STEP):  # windows overlap by the widest filter less one
            w = (data[at : at + language.WINDOW] + [0] * language.WINDOW)[: language.WINDOW]
            pooled = [max(sum(float(t[j][w[k + j]][f]) for j in range(n)) for k in range(language.WINDOW - n + 1)) for n, t in net.tables.items() for f in range(t.shape[2])]
            z = np.maximum(np.array(pooled) + net.bias, 0) @ net.weights + net.offset
            p = np.exp(z - z.max())
            share = sum(c > 0 for c in w[: language.STEP])
            total, weight = total + p / p.sum() * share, weight + share
        assert got[i].lang_pred == net.languages[int(total.argmax())] and abs(got[i].score - (total / weight).max()) < 1e-3


def test_language_sample_is_one_row_an_id(spark):
    rows = [(1, "aaa bbb", "en")] * 50 + [(k, f"ccc ddd {k}", "de") for k in range(3, 9)]
    net = language.fit(docs_of(spark, rows))
    assert net.languages == ["de", "en"]


def test_labelled_sample(spark):
    """Long texts count, one row an id, nulls and other folds do not, equal samples from equal tables."""
    from umitally.llm.common import labelled_sample

    docs = docs_of(spark, [(1, "b", "x"), (1, "a", "x"), (3, None, "x"), (4, "y" * 200_000, "x"), (None, "n", "x"), (7, "only", "x")])
    marks = spark.createDataFrame([(1, 0), (1, 1), (3, 1), (4, 0), (None, 1), (7, None)], "doc_id bigint, toxic int")
    got = labelled_sample(docs, marks, "toxic", modulus=1000, remainder=1000, limit=10, columns=["text", "n_chars"]).to_pylist()
    assert [(r["doc_id"], len(r["text"]), r["n_chars"], r["_label"]) for r in got] == [(1, 1, 1, 1), (4, 200_000, 200_000, 0)]
    assert labelled_sample(docs, marks, "toxic", modulus=1000, remainder=1000, limit=1, columns=["text"]).num_rows == 1


def test_quality_edges(edge, empty, labels):
    assert {r.score for r in quality.predict(edge, labels.where("false")).collect()} == {0.5}
    few = quality.predict(edge.drop("n_chars"), labels.where("doc_id < 11"))
    assert few.count() == len(EDGE) and quality.predict(empty, labels).count() == 0
    model = quality.train(*quality.vectors(["a b"], [3], quality._Cached()), np.array([1.0]))
    assert quality.score(edge, model).columns == [*(c for c in edge.columns if c != "score"), "score"]


def test_language_held_out(documents):
    got = {r.doc_id: r for r in language.predict(documents).collect()}
    lang = {r.doc_id: r.lang for r in documents.collect()}
    out = [i for i in lang if got[i].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert np.mean([got[i].lang_pred == lang[i] for i in out]) > 0.97


def test_windows_cover_every_run():
    for n in (0, 1, 255, 256, 257, 600, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        w = language.windows(text)
        runs = {bytes(row[k : k + 4]) for row in w for k in range(language.WINDOW - 3)}
        data = language.CLASS_OF[np.frombuffer(text.encode(), np.uint8)].tobytes()
        assert all(data[k : k + 4] in runs for k in range(n - 3)) and len(w) == max(1, -(-(n - language.WINDOW + language.STEP) // language.STEP))


def test_language_pairs_equal_single_rows():
    x = np.random.default_rng(3).integers(0, language.CLASSES, (5, language.WINDOW)).astype(np.uint8)
    net = language.train(x, np.array([0, 1, 0, 1, 0]), ["a", "b"], epochs=1)
    want = [np.max([sum(t[j][row[k + j]] for j in range(w)) for k in range(language.WINDOW - w + 1)], axis=0) for row in x for w, t in net.tables.items()]
    assert np.allclose(net.pooled(x).reshape(-1), np.concatenate(want), atol=1e-4)


@pytest.mark.parametrize(("text", "letter"), [(None, False), ("", False), ("12 \u00b2 \u00bd \u2167 _", False), ("\u00b2 a", True), ("\u00e9", True), ("\u6f22", True), ("\U0001f642", False)])
def test_letters(text, letter):
    assert language.has_letter(text) is letter


def test_language_edges(edge, empty):
    rows = language.predict(edge).collect()
    assert len(rows) == len(EDGE) and all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (2, 3, 4))
    assert language.predict(empty).count() == 0
    assert {r.lang_pred for r in language.predict(edge.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# 6 WARC


def by_hand(rows):
    """page_id -> (bytes, digest, type, refers_to) for distinct ids."""
    holder = {}
    for i, h in rows:
        holder[h or ""] = max(i, holder.get(h or "", i))
    out = {}
    for i, h in rows:
        b = (h or "").encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out[i] = (len(b), d, *(("response", None) if holder[h or ""] == i else ("revisit", holder[h or ""])))
    return out


def test_warc_round_trip(spark):
    rows = [(i, f"http://x/{i} ü", random.Random(i % 40).choice(["", None, "<p>é</p>" * (i % 7), "x" * (i % 11)])) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"sha1": F.lit(1), "id": F.lit(2)})
    folders = [shared_dir(spark) for _ in range(2)]
    made = [warc.write_archives(pages.repartition(n), f, shard_rows=50, roll_bytes=3000) for n, f in zip((1, 5), folders, strict=True)]
    assert made[0] == made[1] and made[0]["records"] == 200 and made[0]["shards"] == 4 and made[0]["files"] > 4  # the same files whatever the input's order
    files = [[x for k in range(4) for x in warc.files_of(*warc._target(f), k)] for f in folders]
    assert files[0] == files[1] and [len(files[0]), sum(x["bytes"] for x in files[0])] == [made[0]["files"], made[0]["bytes"]]
    got = warc.read_archives(spark, folders[0]).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == by_hand([(i, h) for i, _, h in rows])
    html = {i: (h or "").encode() for i, _, h in rows}
    assert all(r.payload == html[r.page_id] for r in got if r.record_type == "response")
    name = files[0][0]["name"]
    raw = open(folders[0].removeprefix("file://") + "/" + name, "rb").read()
    assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and hashlib.sha256(raw).hexdigest() == files[0][0]["sha256"]


def test_warc_edges(spark):
    schema = "page_id bigint, url string, html string"
    rows = [(1, None, "a"), (1, None, "a"), (1, "u", "b"), (None, None, "a"), (None, None, None), (2, "v\r\nX: y", "z" * 300_000)]
    folder = shared_dir(spark)
    warc.write_archives(spark.createDataFrame(rows, schema), folder)
    got = warc.read_archives(spark, folder).collect()
    assert len(got) == len(rows) and Counter(r.record_type for r in got) == {"response": 4, "revisit": 2}
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {1}
    folder = shared_dir(spark)
    assert warc.write_archives(spark.createDataFrame([], schema), folder)["files"] == 0 and warc.read_archives(spark, folder).count() == 0
    folder = shared_dir(spark)
    warc.write_archives(spark.createDataFrame(rows[:2], schema), folder, least_bytes=2)
    assert {r.record_type for r in warc.read_archives(spark, folder).collect()} == {"response"}


def test_warc_splitters(spark):
    """As many shards as asked for, of about equal size, the same for equal tables, whatever the type of the id."""
    pages = spark.range(20_000).select((F.col("id") * 7 - 50_000).alias("page_id"))
    for ids in (pages, pages.select(F.concat(F.lit("p"), F.col("page_id")).alias("page_id"))):
        cuts = warc.splitters(ids.unionByName(ids.limit(100)), "page_id", 40)
        assert len(cuts) == 39 and cuts == sorted(set(cuts)) == warc.splitters(ids.repartition(7), "page_id", 40)
        rows = sorted(r.page_id for r in ids.collect())
        sizes = np.diff([0, *(rows.index(c) for c in cuts), len(rows)])
        assert sizes.min() > 200 and sizes.max() < 1000
    assert warc.splitters(pages, "page_id", 1) == [] == warc.splitters(pages.limit(0), "page_id", 5)
    assert len(warc.splitters(pages.limit(3), "page_id", 5)) <= 3


# 7 SimHash


def test_simhash_edits(spark, documents):
    got = {r.doc_id: r for r in simhash.with_edits(documents).collect()}
    text = texts_of(documents)
    order = sorted(text, reverse=True)
    distance = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / simhash.BITS
    seen = {}
    for k, i in enumerate(order):
        r, nxt = got[i], order[(k + 1) % len(order)]
        n = len(text[i])
        edited = text[i][: n - n // 3] + text[nxt][: n // 3]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(text[i], r.fingerprint) == r.fingerprint
        assert abs(r.near_edited - distance(r.fingerprint, r.edited_fingerprint)) < 1e-12 and abs(r.near_next - distance(r.fingerprint, got[nxt].fingerprint)) < 1e-12
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.98
    prints = {int(r.fingerprint, 16): min(q.doc_id for q in got.values() if q.fingerprint == r.fingerprint) for r in got.values()}
    for i, r in got.items():
        if i % 50:
            assert r.n_near is None and r.nearest_id is None
            continue
        near = [(d, least) for fp, least in prints.items() if 0 < (d := (fp ^ int(r.fingerprint, 16)).bit_count()) <= simhash.RADIUS]
        assert (r.n_near, r.nearest_id) == (len(near), min(near, default=(None, None))[1])


def test_simhash_votes(spark):
    """The packed sums against a plain count of signed votes."""
    df = spark.createDataFrame([(1, "a bb ccc a bb dddd"), (2, ""), (3, "one"), (4, LONG[:5000])], "k bigint, text string")
    terms = df.select("k", F.explode(simhash.terms(F.col("text"))).alias("t")).select("k", "t", F.xxhash64("t").alias("a"), F.xxhash64("t", F.lit(1)).alias("b")).collect()
    got = {r.k: r.fp for r in simhash.fingerprints(df, ["k"]).select("k", simhash.as_hex(F.col("_fp")).alias("fp")).collect()}
    for k in (1, 2, 3, 4):
        words = []
        for h in ("a", "b"):
            votes = [sum((t.t & 7) * (1 if t[h] >> i & 1 else -1) for t in terms if t.k == k) for i in range(64)]
            bits = sum(1 << i for i, v in enumerate(votes) if v > 0)
            words += [bits & 0xFFFFFFFF, bits >> 32]
        assert got[k] == "".join(f"{w:08x}" for w in words)


@pytest.mark.parametrize(("radius", "blocks"), [(0, None), (1, 3), (3, None), (3, 6), (5, 6)])
def test_simhash_neighbours(spark, radius, blocks):
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(20)]
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(128), n))
    all_ = [f"{x:032x}" for b in base for x in (b, b, *(flip(b, n) for n in range(1, 7)))]
    fps = spark.createDataFrame([(x,) for x in all_], "fingerprint string")
    want = {(a, b, (int(a, 16) ^ int(b, 16)).bit_count()) for a in all_ for b in all_ if (int(a, 16) ^ int(b, 16)).bit_count() <= radius}
    assert {tuple(r) for r in simhash.neighbours(fps, fps, radius, blocks).collect()} == want


@pytest.mark.parametrize(("radius", "blocks"), [(simhash.RADIUS, None), (5, 4), (12, 5)])
def test_simhash_wide_neighbours(spark, radius, blocks):
    """Radii that need blocks with flipped bits; distances on both sides of the radius, high bits included."""
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(10)] + [0, (1 << 128) - 1]
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(128), n))
    all_ = [f"{x:032x}" for b in base for x in (b, b, *(flip(b, n) for n in range(1, radius + 4)))]
    fps = spark.createDataFrame([(x,) for x in all_], "fingerprint string")
    want = {(a, b, d) for a in set(all_) for b in set(all_) if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= radius}
    got = [tuple(r) for r in simhash.neighbours(fps, fps, radius, blocks).collect()]
    assert len(got) == len(want) and set(got) == want


def test_simhash_finds_near_copies(spark):
    """Copies at a Jaccard similarity of 0.75 and more (of five-word shingles) of a text among unrelated ones."""
    rng = random.Random(11)
    rows = [(50 * g + k, " ".join(words if k else base)) for g in range(12) for base in [[f"{rng.choice('abcdefgh')}{rng.randint(0, 9**5)}" for _ in range(200)]] for k in range(3) for words in [[f"new{k}" if i in (60 * k, 130) else w for i, w in enumerate(base)]]]
    sets = {i: shingle_set(t) for i, t in rows}
    alike = {i: {j for j in sets if j != i and len(sets[i] & sets[j]) >= 0.75 * len(sets[i] | sets[j])} for i in sets}
    got = {r.doc_id: r for r in simhash.with_edits(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id % 50 = 0").collect()}
    assert len(got) == 12 and all(len(alike[i]) == 2 and r.n_near == 2 and r.nearest_id in alike[i] for i, r in got.items())


def test_simhash_blocks_follow_the_corpus(spark):
    """More fingerprints take fewer blocks with longer keys and more flips, so a query's work grows far slower than the corpus."""
    few = simhash.choose_blocks(10**4, 10**6 // 50)
    assert few == simhash.BLOCKS and simhash.choose_blocks(10**9, 5 * 10**10) < few
    for n in (10**5, 10**6, 10**7, 10**8):
        work = [simhash.expected_work(m, simhash.choose_blocks(m // 50, m)) for m in (n, 100 * n)]
        assert work[1] < 40 * work[0]
    met = [simhash.expected_candidates(m, simhash.choose_blocks(m // 50, m)) / m for m in (10**5, 10**7, 10**9)]
    assert met[0] > 2 * met[1] > 4 * met[2]
    rng = random.Random(9)
    base = [rng.getrandbits(128) for _ in range(12)]
    near = [x ^ sum(1 << i for i in rng.sample(range(128), rng.randint(20, 30))) for x in base for _ in range(6)]
    prints = sorted({f"{x:032x}" for x in base + near})
    fps = spark.createDataFrame([(x,) for x in prints], "fingerprint string")
    asked = fps.where(F.col("fingerprint").isin(prints[:6]))
    want = {(a, b, d) for a in prints[:6] for b in prints if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= simhash.RADIUS}
    for blocks in (7, 9):
        assert {tuple(r) for r in simhash.neighbours(asked, fps, simhash.RADIUS, blocks).collect()} == want


def test_simhash_lists_neighbours_and_copies(spark, documents):
    texts = [(i, t) for i, t in sorted(texts_of(documents).items()) if i < 300]
    base = " ".join(f"w{i}" for i in range(200))
    rows = [*texts, *((1000 + i, base) for i in range(5)), (1005, base.replace("w60 ", "x ")), (1006, base.replace("w60 ", "x ")), (1007, base.replace("w9 ", "y ")), (1050, "alone in the world"), (None, base)]
    rows += rows[-5:-3]  # repeated rows are one document
    got = simhash.with_edits(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    by = defaultdict(set)
    for r in got:
        by[r.fingerprint].add(r.doc_id)
    for r in got:
        if r.doc_id is None or r.doc_id % 50:
            assert r.n_copies is None and r.neighbours is None
            continue
        near = sorted((d, min(i for i in ids if i is not None), fp, len(ids)) for fp, ids in by.items() if 0 < (d := (int(fp, 16) ^ int(r.fingerprint, 16)).bit_count()) <= simhash.RADIUS)
        assert (r.n_copies, [tuple(x) for x in r.neighbours]) == (len(by[r.fingerprint]) - 1, near) and r.n_near == len(near)
    one = next(r for r in got if r.doc_id == 1000)
    assert one.n_copies == 5 and {(x.doc_id, x.n_docs) for x in one.neighbours} == {(1005, 2), (1007, 1)} and next(r for r in got if r.doc_id == 1050).neighbours == []


def test_simhash_edges(spark, edge, empty):
    rows = simhash.with_edits(edge).collect()
    assert len(rows) == len(EDGE) and {r.fingerprint for r in rows if r.doc_id in (2, 3, 4)} == {"0" * 32}
    assert simhash.with_edits(empty).count() == 0
    one = simhash.with_edits(docs_of(spark, [(1, "abcdef gh", "en")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest() and one.near_next == 1.0


# 8 chat


def test_chat_links_and_order(spark):
    call = json.dumps({"content": "c", "tool_calls": [{"id": "a", "name": "search", "arguments": {"query": "q]", "limit": 3, "zz": {"k": [1, 2], "a": None}}}, {"id": "b", "name": "nope", "arguments": {}}]})
    rows = [
        (1, 0, "user", 'hi "there"\n[x]'), (1, 1, "assistant", call), (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "r"})),
        (2, 0, "tool", json.dumps({"tool_call_id": "c", "content": "early"})), (2, 1, "assistant", json.dumps({"tool_calls": [{"id": "c", "name": "convert", "arguments": {"value": "x", "unit": "ft"}}]})),
        (2, 2, "assistant", json.dumps({"tool_calls": [{"id": "c", "name": "convert", "arguments": {"value": 1.5, "unit": "km"}}]})),
        (3, 0, "tool", json.dumps({"tool_call_id": "zz", "content": None})), (3, 1, "assistant", "{bad"), (3, 1, "assistant", "{bad"), (None, None, None, None), (None, 4, "tool", json.dumps({"tool_call_id": "a"})),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({"kind": F.lit(1), "calls": F.lit(2)})
    got = chat.messages(df).collect()
    assert len(got) == len(rows)
    key = lambda r: (r.conv_id if r.conv_id is not None else -1, r.anchor_turn if r.anchor_turn is not None else -1, r.step, r.turn if r.turn is not None else -1)
    two = [(r.turn, r.kind, r.linked, r.problems) for r in sorted(got, key=key) if r.conv_id == 2]
    assert two == [(1, "call", 1, "value is no number; unit is not allowed"), (0, "result", 1, None), (2, "call", 0, "")]
    one = {r.turn: r for r in got if r.conv_id == 1}
    assert one[1].problems == "unexpected zz; unknown tool" and one[1].linked == 1 and one[2].linked == 1
    assert one[1].json == '{"role":"assistant","content":"c","tool_calls":[{"id":"a","name":"search","arguments":{"limit":3,"query":"q]","zz":{"a":null,"k":[1,2]}}},{"id":"b","name":"nope","arguments":{}}]}'
    assert json.loads(one[0].json) == {"role": "user", "content": 'hi "there"\n[x]'}
    three = [r for r in got if r.conv_id == 3]
    assert sorted(json.loads(r.json).get("orphan", False) for r in three) == [False, False, True] and [r.kind for r in three].count("message") == 2
    assert chat.messages(df.limit(0)).count() == 0


@pytest.mark.parametrize(("before", "after"), [("\n", ""), (" \t\r\n", "\n"), ("", " \n")])
def test_chat_white_space_around_objects(spark, before, after):
    call = json.dumps({"content": "c", "tool_calls": [{"id": "a", "name": "search", "arguments": {"query": "q"}}]})
    result = json.dumps({"tool_call_id": "a", "content": "r"})
    rows = [(1, 0, "assistant", call), (1, 1, "tool", result), (1, 2, "assistant", "\n plain ")]
    df = lambda a, b: spark.createDataFrame([(c, t, r, a + x + b if x[0] == "{" else x) for c, t, r, x in rows], "conv_id bigint, turn bigint, role string, text string")
    got = sorted(map(tuple, chat.messages(df(before, after)).collect()), key=lambda r: r[1])
    assert got == sorted(map(tuple, chat.messages(df("", "")).collect()), key=lambda r: r[1])
    assert [r[5] for r in got] == ["call", "result", "message"] and json.loads(got[2][9])["content"] == "\n plain "


def test_chat_loses_no_call(spark):
    """Repeated member names, numbers without end, integral fractions, arguments as text, and schemas within schemas."""
    call = lambda arguments, tool="search": f'{{"content":"c","tool_calls":[{{"id":"a","name":"{tool}","arguments":{arguments}}}]}}'
    deep = {"properties": {"o": {"type": "object", "properties": {"k": {"type": "integer", "enum": [2, 3]}}, "required": ["k"]}, "l": {"type": "array", "items": {"type": "string"}}}}
    bad = "arguments are no valid object"
    cases = [
        (call('{"query":"x","query":"y"}'), bad, '{"query":"x","query":"y"}'), (call('{"value":1e400,"unit":"km"}', "convert"), bad, None), (call('{"query":"Infinity"}'), "", {"query": "Infinity"}),
        (call('{"query":"x","limit":3.0}'), "", {"limit": 3, "query": "x"}), (call('{"query":"x","limit":3.5}'), "limit is no integer", {"limit": 3.5, "query": "x"}),
        (call(json.dumps('{"query":"x"}')), "", {"query": "x"}), (call('"oops"'), bad, "oops"), (call("[1]"), bad, "[1]"), (call("{}"), "missing query", {}),
        (call('{"o":{"k":"z","y":1},"l":["a",1,2]}', "deep"), "o.k is no integer; o.k is not allowed; unexpected o.y; l[] is no string", {"l": ["a", 1, 2], "o": {"k": "z", "y": 1}}),
        (call('{"o":{},"l":3}', "deep"), "missing o.k; l is no array", {"l": 3, "o": {}}), (call('{"o":{"k":2.0}}', "deep"), "", {"o": {"k": 2}}), ('{"tool_calls":[{"id":"q","name":"search"}]}', "missing query", {}),
    ]
    rows = [(k, 1, "assistant", t) for k, (t, _, _) in enumerate(cases)] + [(0, 2, "tool", '{"tool_call_id":"a","content":"x","content":"z"}'), (0, 3, "assistant", '{"tool_calls":[{"id":"q"')]
    got = {(r.conv_id, r.turn): r for r in chat.messages(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), chat.TOOLS | {"deep": deep}).collect()}
    for k, (_, problems, arguments) in enumerate(cases):
        r = got[k, 1]
        assert (r.kind, r.problems) == ("call", problems)
        if arguments is not None:
            assert json.loads(r.json)["tool_calls"][0]["arguments"] == arguments
    assert got[0, 1].linked == 1 and (got[0, 2].kind, got[0, 2].linked) == ("result", 1) and json.loads(got[0, 2].json)["content"] == "z" and got[0, 3].kind == "message"


def test_chat_plan_is_small(spark):
    """The plan of the result, which the driver makes again after each stage, parses nothing: 700,000 characters when it did."""
    plan = queries.op8_chat(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60_000 and "from_json" not in plan and "variant" not in plan


# 9 exact deduplication


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i, t))
    out = []
    for norm, g in groups.items():
        keep = min(g, key=lambda x: x[:2] + ((x[2] or 0),))[2]
        out += [(i, keep, len(g), hashlib.sha256(norm.encode()).hexdigest()) for _, _, i, _ in g]
    return Counter(out)


@pytest.mark.parametrize("parts", [1, 6])
def test_exact_classes(spark, documents, edge, parts):
    for df in (documents, edge, edge.unionByName(edge)):
        got = exact_dedup.dedup_classes(df.repartition(parts)).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == exact_by_hand([(r.doc_id, r.text) for r in df.collect()])
        kept = [r for r in got if r.kept]
        assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)
        rows = exact_dedup.dedup_rows(df.repartition(parts))
        assert rows.columns == df.columns and sorted(map(repr, (r.doc_id for r in rows.collect()))) == sorted(map(repr, (r.doc_id for r in kept)))


def test_exact_group_over_many_ranges(spark):
    """A group that has a row in every batch goes to many ranges, and no task gets them all."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = [(k, "hot text" + " " * (k % 3) if k % 3 else f"text {k}", "en") for k in range(3000)] + [(5000 + k, "", "en") for k in range(200)] + [(None, "h o t text", "en")]
        docs = docs_of(spark, rows)
        names = list(exact_dedup._KEYS)
        from pyspark.sql import types as T

        schema = T.StructType([T.StructField(n, t) for n, t in zip(["doc_id", "text", *names], [T.LongType(), T.StringType(), *exact_dedup._KEY_TYPES], strict=True)])
        reps = docs.select("doc_id", "text").mapInArrow(lambda it: exact_dedup._collapse(it, 0, 1, True, ["doc_id", "text", *names]), schema)
        per_task = [r["n"] for r in exact_dedup._sorted_by_content(reps, names).withColumn("p", F.spark_partition_id()).where("text LIKE 'hot%' OR text LIKE 'h o t%'").groupBy("p").agg(F.count("*").alias("n")).collect()]
        assert sum(per_task) >= 600 and max(per_task) < 0.6 * sum(per_task)
        got = exact_dedup.dedup_classes(docs).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == exact_by_hand([(r[0], r[1]) for r in rows])
        assert sorted(r.doc_id for r in exact_dedup.dedup_rows(docs).collect()) == sorted(r.doc_id for r in got if r.kept)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])


def test_exact_empty(empty):
    assert exact_dedup.dedup_classes(empty).count() == 0 and exact_dedup.dedup_rows(empty).count() == 0


# 10 Jaccard join


def shingle_set(text, size=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard_by_hand(rows, size=5, least=75):
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for j in {j for t in s for j in where[t]}:
            c = len(s & sets[j][1])
            if 100 * c >= least * (len(s) + len(sets[j][1]) - c):
                root[find(k)] = find(j)
        for t in s:
            where[t].append(k)
    first = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        first[r] = i if first.get(r) is None else first[r] if i is None else min(i, first[r])
    return Counter((i, len(s), first[find(k)]) for k, (i, s) in enumerate(sets))


def as_counter(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_jaccard_documents(documents):
    assert as_counter(jaccard.jaccard_classes(documents)) == jaccard_by_hand(list(texts_of(documents).items()))


def test_jaccard_edges(spark, edge, empty):
    assert as_counter(jaccard.jaccard_classes(edge)) == jaccard_by_hand([(r.doc_id, r.text) for r in edge.collect()])
    assert jaccard.jaccard_classes(empty).count() == 0


def mutants(seed, groups, size, words, share):
    rng = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 9**6)}" for _ in range(words)]
        for _ in range(size):
            copy = [w if rng.random() > share else f"m{rng.randint(0, 9**6)}" for w in base]
            rows.append((i, " ".join(copy)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "share"), [(1, 0.01), (2, 0.03), (3, 0.045)])
def test_jaccard_hot_groups(spark, seed, share):
    """Groups of near copies that are frequent by far: second pivots, Voronoi regions and boundary windows are needed."""
    rows = mutants(seed, 2, 120, 80, share) + [(1000 + k, f"only{k} a{k} b{k} c{k} d{k} e{k}") for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = jaccard.frequency_sketch(df)
    assert (jaccard.frequency_classes(counts) > 0).sum() > 20
    got = as_counter(jaccard.jaccard_classes(df))
    assert got == jaccard_by_hand(rows) and len({c for _, _, c in got}) > 51


def copies(n, edits, words=200):
    """n copies of one text, each with its own words at `edits` places."""
    rng = random.Random(edits)
    base = [f"b{i}" for i in range(words)]
    return [(k, " ".join(f"e{k}x{i}" if i in places else w for i, w in enumerate(base))) for k in range(n) for places in [set(rng.sample(range(words), edits))]]


@pytest.mark.parametrize("edits", [2, 4, 6])
def test_jaccard_comparisons_grow_linearly(spark, monkeypatch, edits):
    made, compare = [], jaccard.compare
    monkeypatch.setattr(jaccard, "compare", lambda pairs, contents: made.append(pairs.count()) or compare(pairs, contents))
    total = []
    for n in (200, 400):
        rows = copies(n, edits)
        made.clear()
        assert as_counter(jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string"))) == jaccard_by_hand(rows)
        total.append(sum(made))
    assert total[0] < 3 * 200 and total[1] < 2.5 * total[0]


def test_jaccard_comparisons_of_many_copies(spark, monkeypatch):
    """800 copies with 6056 links: still no more than three comparisons a document."""
    made, compare = [], jaccard.compare
    monkeypatch.setattr(jaccard, "compare", lambda pairs, contents: made.append(pairs.count()) or compare(pairs, contents))
    rows = copies(800, 4)
    assert as_counter(jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string"))) == jaccard_by_hand(rows)
    assert sum(made) < 3 * 800


def test_jaccard_rows_that_repeat_ids(spark):
    """Rows are told by id and text: an unrelated row that repeats an id that goes stays, and null ids come last."""
    base = copies(4, 1)
    rows = [(1, base[0][1]), (5, base[1][1]), (5, "an unrelated text of its own words"), (None, base[2][1]), (None, "another text that has no partner"), (None, None), (2, None), (1, "one more of its kind here"), (None, "x y"), (9, "x y")]
    kept = jaccard.dedup_rows(docs_of(spark, [(i, t, "en") for i, t in rows])).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(rows) - Counter([rows[1], rows[3], (None, "x y")])


def test_jaccard_leaves_only_its_result(spark):
    before = set(spark.sparkContext._jvm.java.io.File(shared_dir(spark).removeprefix("file://")).getParentFile().list() or [])
    got = jaccard.jaccard_classes(docs_of(spark, [(1, "a b c d e f", "en"), (2, "a b c d e f", "en")]))
    after = set(spark.sparkContext._jvm.java.io.File(shared_dir(spark).removeprefix("file://")).getParentFile().list())
    assert len(after - before) == 1 and got.count() == 2


@pytest.mark.parametrize("most", [jaccard.BROADCAST_IDS, 1])
def test_jaccard_rows_that_stay(spark, monkeypatch, most):
    """Few ids that go are broadcast whatever their table's estimated size, so texts stay where they are; many are joined."""
    rows = copies(6, 2) + [(100 + k, f"own{k} a{k} b{k} c{k} d{k}") for k in range(5)] + [(200, None), (None, "x")]
    docs = docs_of(spark, [(i, t, "en") for i, t in rows])
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.dedup_rows(docs)
        assert ("BroadcastHashJoin" in kept._jdf.queryExecution().executedPlan().toString()) == (most > 1)
        assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _, c in jaccard_by_hand(rows) if i == c)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_work_tables_of_two_threads(spark):
    """A query that ends deletes its own tables and not those of another thread's query."""
    import threading

    from umitally.llm.common import temporary_tables, write_table

    written, ended, counts = threading.Event(), threading.Event(), []

    def other():
        with temporary_tables(spark):
            table = write_table(spark.range(5))
            written.set()
            ended.wait(60)
            counts.append(table.count())

    t = threading.Thread(target=other)
    t.start()
    assert written.wait(60)
    with temporary_tables(spark):
        mine = write_table(spark.range(3))
        with temporary_tables(spark):
            inner = write_table(spark.range(2))
        assert mine.count() == 3
    ended.set()
    t.join(60)
    assert counts == [5]
    for gone in (mine, inner):
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
            gone.collect()


def test_jaccard_window_and_bounds():
    rng = np.random.default_rng(4)
    for n in range(1, 60):
        assert jaccard.window(n) == n - int(np.ceil(0.75 * n - 1e-9)) + 1
    for _ in range(200):
        n, m = rng.integers(1, 400, 2)
        common = rng.integers(0, min(n, m) + 1)
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        y = np.concatenate([x[:common], rng.integers(0, 2**63, m - common, dtype=np.uint64)])
        import pandas as pd

        fits = jaccard._parities_fit(pd.Series([n]), pd.Series([m]), pd.Series([jaccard.parities(x)]), pd.Series([jaccard.parities(y)]))[0]
        if 100 * common >= 75 * (n + m - common):
            assert fits


def test_regions():
    """Runs of every size over batches cut anywhere, with copies of rows, against a plain grouping."""
    import pyarrow as pa

    rng = random.Random(5)
    for step in (1, 2, 3, 7, 1000):
        rows = sorted((t, s, 10, 0) for t in range(40) for s in rng.sample(range(100), rng.choice([1, 2, 3, 7, 31, 32, 33, 34, 60])) for _ in range(rng.choice([1, 1, 1, 3])))
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k : k + step], strict=True)], ["token", "sid", "n", "place"]) for k in range(0, len(rows), step)]
        out = [r for b in jaccard._regions(iter(batches)) for r in b.to_pylist()]
        groups = defaultdict(set)
        for t, s, _, _ in rows:
            groups[t].add(s)
        assert sorted((r["token"], r["sid"]) for r in out if r["token"] is not None) == sorted((t, s) for t, g in groups.items() if len(g) > jaccard.SMALL for s in g)
        assert {(r["sid"], r["other"]) for r in out if r["token"] is None} == {(a, b) for g in groups.values() if len(g) <= jaccard.SMALL for a in g for b in g if a < b}
    assert list(jaccard._regions(iter([]))) == []


def test_sketch_in_two_steps(spark, documents, monkeypatch):
    df = documents.limit(60).repartition(5).cache()
    whole = jaccard.frequency_sketch(df)
    monkeypatch.setattr(jaccard, "FAN_IN", 2)
    cached = jaccard._WordHash()
    sets = {s.tobytes(): s for r in df.collect() for s in [jaccard.shingles(r.text, cached)]}
    # Copies count once in a batch, so sums are between those of the distinct texts and of all.
    assert (jaccard.frequency_sketch(df) == whole).all() and sum(map(len, sets.values())) <= whole.sum()


def test_components(spark):
    rng = random.Random(7)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(200 + rng.randint(0, 60), 200 + rng.randint(0, 60)) for _ in range(50)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b) if find(x) != x} | {x: x for x in got if got[x] == x}


# all operators: types of ids and names of columns

SMALL_DOCS = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, "one two three. bad words here!"), (5, "a b c d e f g h")]


def ids_as(spark, kind):
    df = spark.createDataFrame([(i, t, "en", len(t or "")) for i, t in SMALL_DOCS], "doc_id bigint, text string, lang string, n_chars bigint")
    return df.withColumn("doc_id", F.lit(None).cast("bigint") if kind == "null" else F.col("doc_id").cast(kind))


@pytest.mark.parametrize("kind", ["int", "string", "null"])
def test_types_of_ids(spark, labels, kind):
    docs, n = ids_as(spark, kind), len(SMALL_DOCS)
    marks = labels.limit(3).withColumn("doc_id", F.lit(None).cast("bigint")) if kind == "null" else labels.limit(30).withColumn("doc_id", F.col("doc_id").cast(kind))
    assert toxicity.predict(docs, marks, locate=True).count() == quality.predict(docs, marks).count() == language.predict(docs).count() == n
    assert pieces.encode_decode(docs, PIECES).count() == n and packing.pack_words(docs, WORDS).count() >= n
    assert simhash.with_edits(docs if kind != "string" else docs.withColumn("doc_id", F.concat(F.lit("x"), "doc_id"))).count() == n
    exact = exact_dedup.dedup_classes(docs)
    assert exact.schema["keep_id"].dataType == docs.schema["doc_id"].dataType
    assert exact.where("kept").count() == exact_dedup.dedup_rows(docs).count() == 4
    near = jaccard.jaccard_classes(docs)
    assert near.schema["component_id"].dataType == docs.schema["doc_id"].dataType and near.count() == n
    if kind != "null":
        assert {str(r.doc_id): str(r.component_id) for r in near.collect()} == {"1": "1", "2": "1", "3": "3", "4": "4", "5": "1"}
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://x").alias("url"), F.col("text").alias("html"))
    folder = shared_dir(spark)
    warc.write_archives(pages, folder, shard_rows=2)
    got = warc.read_archives(spark, folder, id_type=docs.schema["doc_id"].dataType).collect()
    assert len(got) == n and Counter(r.page_id for r in got) == Counter(r.doc_id for r in docs.collect())


def test_names_of_columns(spark, labels):
    """Extra columns with the names that the operators use themselves keep their values or are not read."""
    import corpus_pipeline

    inner = ["_gid", "gid", "_count", "count", "_points", "points", "prefix", "digest", "part", "place", "entry", "norm", "total", "id", "best", "_n_chars", "_text", "_quality", "_lang", "_score", "_label", "_row", "share", "sid", "n", "token", "parity", "root", "pivot", "a", "b", "_key", "_next", "_n", "_fp", "_which", "_two", "fingerprint", "near", "kept", "keep_id", "shard", "payload", "sha1", "holder", "full", "start", "length", "offset", "score", "predicted", "lang_pred"]
    plain = ids_as(spark, "bigint").withColumn("source", F.lit("s"))
    docs = plain.withColumns({c: F.lit(f"own {c}") for c in inner})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want, got = stage(spark, plain, SF), stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in want.collect()) and all(r[c] == f"own {c}" for r in rows for c in inner), name
    assert packing.pack_words(docs, WORDS).count() >= 5 and pieces.encode_decode(docs, PIECES).count() == simhash.with_edits(docs).count() == 5
    assert toxicity.predict(docs, labels, locate=True).count() == quality.predict(docs, labels).count() == language.predict(docs).count() == 5
    assert exact_dedup.dedup_classes(docs).count() == jaccard.jaccard_classes(docs).count() == 5
    folder = shared_dir(spark)
    warc.write_archives(docs.withColumnRenamed("doc_id", "page_id").withColumn("url", F.lit("u")), folder, payload_col="text")
    assert warc.read_archives(spark, folder).count() == 5


# the pipeline


def test_pipeline_stages(spark, documents):
    import corpus_pipeline

    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.schema.names == documents.schema.names, name
        seen.append({r.doc_id for r in out.collect()})
        docs = out
    everything = set(texts_of(documents))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = {i for i, q in labels.items() if q == 1}
    assert seen[0] <= everything and len(seen[0]) > 0.98 * len(everything)
    assert len(clean & seen[1]) > 0.98 * len(clean & seen[0]) and len({i for i, q in labels.items() if q == 0} & seen[1]) < 0.2 * len(labels)
    kept = texts_of(documents.where(F.col("doc_id").isin(list(seen[1]))))
    by = {(i, k) for i, k, _, _ in exact_by_hand(list(kept.items()))}
    assert seen[2] == {i for i, k in by if i == k}
    near = jaccard_by_hand([(i, kept[i]) for i in seen[2]])
    assert seen[3] == {i for i, _, c in near if i == c}
    check_pieces(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), {i: kept[i] for i in seen[3]})


def test_pipeline_run(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns[:2] == ["doc_id", "start"] and out.count() > 50
