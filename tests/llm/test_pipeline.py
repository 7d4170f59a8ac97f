import re

import public_tokenizers
import tiktoken
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from tests.llm.helpers import components, words

SF = "/root/testdata/sf0.001"


def test_stages_keep_clean_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    base = " ".join(words(90, 77))
    planted = [(9001, base), (9002, base + " more"), (9003, "Lead " + passage + " tail"), (9004, "keep token = abcdefgh1234 here " + " ".join(words(40, 5)))]
    given = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in planted], docs.schema))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"{k}")
        stage(spark, given, SF).write.parquet(path)
        after = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
        given = after
    got = {r.doc_id: r for r in given.collect()}
    assert 9001 in got and 9002 not in got and 9003 not in got
    assert got[9004].text.startswith("keep [SECRET] here") and got[9004].n_chars == len(got[9004].text)
    assert len(got) > 150 and all(r.n_tokens == len(r.ids) // 4 for r in got.values())


def odd_rows(spark):
    """Rows with null and repeated ids, null texts, repeated rows, and columns with names that stages use themselves."""
    base = " ".join(words(90, 77))
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    secret = "keep token = abcdefgh1234 here " + " ".join(words(40, 5))
    texts = [(1, base), (5, base + " more"), (5, "an unrelated text that stands alone"), (None, None), (7, None), (8, ""), (9, secret), (9, secret), (None, "Lead " + passage), (None, "no id but words, naïve 😀")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, row long, toxicity string, _tokens string, id string, doc string, own string, rest string, part long"
    return texts, spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "a", 1, "b", "c", "d", "e", "f", "g", 2) for i, t in texts], schema)


def test_stages_keep_odd_rows_and_clashing_columns(spark, tmp_path):
    texts, given = odd_rows(spark)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, given, SF).write.parquet(str(tmp_path / f"{k}"))
        after = spark.read.parquet(str(tmp_path / f"{k}"))
        assert after.columns[: len(given.columns)] == given.columns, name
        assert {tuple(r) for r in after.select("lang", "source", "row", "toxicity", "_tokens", "id", "doc", "own", "rest", "part").collect()} == {("en", "s", 1, "b", "c", "d", "e", "f", "g", 2)}, name
        given = after
    got = sorted(((r.doc_id, r.text, r.n_chars, r.ids, r.n_tokens > 0, len(r.ids_new) // 4 == r.n_tokens) for r in given.collect()), key=str)
    masked = texts[6][1].replace("token = abcdefgh1234", "[SECRET]")
    left = [(1, texts[0][1]), (5, texts[2][1]), (None, None), (7, None), (8, ""), (9, masked), (None, texts[9][1])]
    assert got == sorted([(i, t, None if t is None else len(t), "a", bool(t), True) for i, t in left], key=str)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_run_is_brute_force(spark):
    """The stages together over sf0.001, each by a plain version of its own (the classifier's and the battery's decisions are taken from the operators)."""
    from lithos.llm import secrets, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"), held_out=None)
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    left = {r.doc_id: r.text or "" for r in docs.collect() if score[r.doc_id] < corpus_pipeline.TOXIC}
    sets = {i: shingles(t) for i, t in left.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    group = components(sets, links)
    left = {i: t for i, t in left.items() if group[i] == i}
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    lower = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    known = {tuple(w[i : i + min(10, len(w))]) for w in map(lower, [t for _, t in items]) if w for i in range(max(1, len(w) - 9))}
    left = {i: t for i, t in left.items() if not any(tuple(w[k : k + n]) in known for w in [lower(t)] for n in {len(x) for x in known} for k in range(len(w) - n + 1))}
    frame = spark.createDataFrame(list(left.items()), "doc_id long, text string")
    spans = {r.doc_id: sorted((x.start, x.end) for kind in secrets.KINDS for x in r[kind]) for r in secrets.secret_spans(frame).collect()}
    for i, own in spans.items():
        out, at = "", 0
        for a, b in own:
            out, at = (out + left[i][at:a] + "[SECRET]", b) if a >= at else (out, max(at, b))
        left[i] = out + left[i][at:]
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    bpe = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.text or "", r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: (t, len(bpe.encode_ordinary(t))) for i, t in left.items()}


def test_stages_on_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_run_writes_each_stage_but_the_last(spark, monkeypatch):
    read = []

    def stage(spark, docs, sf_dir):
        read.append(docs.inputFiles())
        return docs.limit(3)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", stage), ("second", stage), ("third", stage)])
    assert corpus_pipeline.run(spark, SF).count() == 3
    assert all("documents.parquet" in f for f in read[0])
    for files, name in zip(read[1:], ["first", "second"], strict=True):
        assert files and all(f"/{name}-" in f for f in files)
