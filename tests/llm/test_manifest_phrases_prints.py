import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lithos.llm import merkle, minhash, phrases
from lithos.llm._sha import START, finished, hex_block, resumed
from lithos.llm.queries import LEAF_FIELDS
from tests.llm.helpers import components, documents, rows, words


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


# --- op13


def test_states_of_blocks_are_the_librarys():
    digests = np.frombuffer(random.Random(1).randbytes(32 * 5000), np.uint8).reshape(-1, 32)
    state = resumed(np.repeat(START[None, :], 5000, axis=0), hex_block(digests))
    state = resumed(state, hex_block(digests[::-1]))
    got = finished(state, np.full(5000, 2))
    for i in (0, 1, 4095, 4096, 4999):
        assert got[i].tobytes().hex() == h(digests[i].tobytes().hex() + digests[4999 - i].tobytes().hex())


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def forest(docs):
    """Of each document: leaf, subroot, root, siblings, folded root; by plain recursion."""

    def grow(level):
        """Digest of the tree, and each leaf's list of (slot, run)."""
        paths, owner = [[] for _ in level], [[i] for i in range(len(level))]
        while len(level) > 1:
            above, owners = [], []
            for s in range(0, len(level), 16):
                run = level[s : s + 16]
                for slot, node in enumerate(owner[s : s + 16]):
                    for i in node:
                        paths[i].append((slot, run))
                above.append(h("".join(run)))
                owners.append([i for node in owner[s : s + 16] for i in node])
            level, owner = above, owners
        return level[0], paths

    key = lambda v: (v is not None, v if v is not None else "")
    sources = sorted({d[3] for d in docs}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((d for d in docs if d[3] == s), key=lambda d: (key(d[0])[0], d[0] or 0, bytes.fromhex(leaf([d[0], d[3], d[2], d[4], d[1]]))))
        trees[s] = own, *grow([leaf([d[0], d[3], d[2], d[4], d[1]]) for d in own])
    root, tops = grow([trees[s][1] for s in sources])
    out = []
    for k, s in enumerate(sources):
        own, sub, paths = trees[s]
        for d, path in zip(own, paths, strict=True):
            mine = leaf([d[0], d[3], d[2], d[4], d[1]])
            bad = zlib.crc32(("" if d[0] is None else str(d[0])).encode()) % 5 == 0
            folded = leaf([d[0], d[3], d[2], d[4], None if d[1] is None else low(d[1])]) if bad else mine
            proof = ""
            for slot, run in path + tops[k]:
                proof += "".join(run[:slot] + run[slot + 1 :])
                folded = h("".join(run[:slot]) + folded + "".join(run[slot + 1 :]))
            out.append((str(d[0]), mine, sub, root, h(proof), folded, folded == root))
    return sorted(out)


def manifest_rows(spark, docs, parts=3):
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string").repartition(parts)
    leaves = merkle.leaf_digests(df, LEAF_FIELDS, tree="source", order="doc_id", changed=(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0, {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}))
    return sorted((str(r.id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in merkle.merkle_proofs(leaves).collect())


def test_manifest_is_that_of_plain_recursion(spark):
    sources = [None, "", "hot", "é", "Z", "pair"] + [f"s{k}" for k in range(20)]
    docs = [(i, f"Text {i}" if i % 3 else f"text {i}", None if i % 7 == 0 else "en", "hot" if i % 3 == 0 else sources[i % len(sources)], i, "x", "y") for i in range(900)]
    docs += [(None, "No id", "en", "hot", 5, "x", "y"), (4, None, None, None, None, "x", "y"), (7, "", "en", "hot", 0, "x", "y"), (7, "B", "en", "hot", 0, "x", "y"), (7, "B", "en", "hot", 0, "x", "y"), (2000, "L" + "o" * 100_000, "en", "alone", 1, "x", "y")]
    assert manifest_rows(spark, docs) == forest(docs)


@pytest.mark.parametrize("count", [1, 2, 16, 17, 256, 257])
def test_manifest_of_one_source(spark, count):
    docs = [(i, f"T{i}", "en", "s", 1, "x", "y") for i in range(count)]
    assert manifest_rows(spark, docs) == forest(docs)


def test_manifest_of_nothing(spark):
    assert manifest_rows(spark, []) == []


# --- op12


def brute_phrases(docs, depth, least, percent, top):
    counts, n = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, depth + 1):
                counts.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    cand = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= least}
    dropped = set()
    for (lang, p), f in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                s = (lang, p[i : i + k])
                if 100 * f >= percent * counts[s]:
                    dropped.add(s)
    out = []
    for lang in n:
        scored = []
        for (g, p), a in cand.items():
            if g == lang and (g, p) not in dropped:
                score, _, left, right = min((1000000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def phrase_rows(spark, docs, **more):
    df = spark.createDataFrame([(i, t, g, 1, "x") for i, (t, g) in enumerate(docs)], "doc_id long, text string, lang string, f long, phrase string").repartition(3)
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.collocations(df, **more).collect())


@pytest.mark.parametrize(("depth", "budget"), [(3, 1 << 20), (3, 40), (2, 300), (4, 25)])
def test_phrases_are_those_of_brute_force(spark, depth, budget):
    rng = random.Random(depth)
    vocabulary = ["New", "york", "city", "is", "the", "of", "ÄB", "straße", "naïve", "a b", "x" * 40]
    docs = [(" ".join(rng.choice(vocabulary) + rng.choice(["", "", ",", ".", "\n", "\t"]) for _ in range(rng.randint(0, 120))), rng.choice(["en", "de", None, "und"])) for _ in range(80)]
    docs += [(None, "en"), ("", "en"), (" ,., ", None), ("one", "xx"), (" ".join(["new york"] * 5000), "en")]
    got = phrase_rows(spark, docs, depth=depth, least=10, keep_percent=50, top=60, budget=budget)
    assert got == brute_phrases(docs, depth, 10, 50, 60) and got


def test_phrases_of_nothing(spark):
    assert phrase_rows(spark, []) == [] and phrase_rows(spark, [("too few words", "en")]) == []


def test_prefixes_are_grouped_within_the_budget():
    loads = [(0, 30), (1, 60), (2, 50), (5, 250), (9, 100), (11, 1)]
    group, parts = phrases._groups(loads, 100)
    filled = Counter()
    for b, load in loads:
        for k in range(parts[b]):
            filled[int(group[b] + k)] += load / parts[b]
    assert max(filled.values()) <= 100 and parts[5] == 3 and len(filled) == 7


# --- op11


def brute_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_fingerprints_estimate_jaccard_and_edits_are_exact(spark):
    docs = [(i, " ".join(words(200 + i, i // 2))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, " \n"), (103, "a"), (104, "😀 ünï code points here are many"), (105, " ".join(words(30_000, 5))), (106, docs[0][1]), (None, "null id comes first"), (107, "x" * 5000)]
    df = documents(spark, docs).repartition(5)
    got = {r.doc_id: r for r in minhash.edited_fingerprints(df).collect()}
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    assert len(got) == len(docs)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == h(edited)
        for value, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = brute_set(text), brute_set(other)
            true = 1.0 if not a and not b else len(a & b) / len(a | b)
            assert abs(value - true) < 0.16, (i, value, true)
        assert (r.near_edited == 1.0) == (r.fingerprint == r.edited_fingerprint)
    assert got[0].fingerprint == got[106].fingerprint and got[100].fingerprint == got[101].fingerprint == ""


def test_edits_over_repeated_ids_and_one_or_no_document(spark):
    one = minhash.edited_fingerprints(documents(spark, [(5, "abcdefgh")])).first()
    assert one.edited_sha256 == h("abcdefab") and one.near_next == 1.0
    assert minhash.edited_fingerprints(documents(spark, [])).collect() == []
    same = minhash.edited_fingerprints(documents(spark, [(1, "same text of five words")] * 30 + [(2, "another")] * 30).repartition(4)).collect()
    assert len(same) == 60 and sum(r.near_next == 1.0 for r in same) == 58


def test_near_duplicates_are_those_of_brute_force(spark):
    rng = random.Random(3)
    docs = []
    for i in range(60):
        w = words(60, i // 6)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"other{rng.randrange(9)}"
        docs.append((i * 3, " ".join(w)))
    docs += [(500, None), (501, ""), (502, "two words"), (503, "two words"), (504, docs[0][1]), (505, docs[0][1].upper())]
    links = []
    for i, (a, x) in enumerate(docs):
        for b, y in docs[i + 1 :]:
            p, q = brute_set(x), brute_set(y)
            if p and q and 100 * len(p & q) >= 80 * len(p | q):
                links.append((a, b))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, docs).repartition(3)).collect()}
    assert got == components([d[0] for d in docs], links) and len(links) > 20


def test_tiles_find_links_that_leaders_miss(spark, monkeypatch):
    """A chain in which each text is near the next alone: no leader links them all."""
    base = [f"w{k}" for k in range(300)]
    docs = [(i, " ".join(base[6 * i : 6 * i + 120])) for i in range(30)]
    links = [(a, b) for i, (a, x) in enumerate(docs) for b, y in docs[i + 1 :] if 100 * len(brute_set(x) & brute_set(y)) >= 80 * len(brute_set(x) | brute_set(y))]
    monkeypatch.setattr(minhash, "TILE", 4)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, docs)).collect()}
    assert got == components([d[0] for d in docs], links) and len(links) >= 29


def test_signatures_do_not_depend_on_slices():
    texts = [" ".join(words(400, k)) for k in range(60)] + [None, ""]
    together, some = minhash.signatures(pa.array(texts, pa.large_string()))
    for k in (0, 17, 59, 60):
        alone, one = minhash.signatures(pa.array([texts[k]], pa.large_string()))
        assert (alone[0] == together[k]).all() and one[0] == some[k]
    assert rows()
