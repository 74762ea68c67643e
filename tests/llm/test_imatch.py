import hashlib
import random
import re
from collections import Counter

import regex
import xxhash
from pyspark.sql import functions as F

from cohortforge.llm import imatch

TERM = regex.compile(r"[\p{L}\p{N}]+")


def signed(n, bits=64):
    return n - (1 << bits) if n >> (bits - 1) else n


def spark_hash(text):
    return signed(xxhash.xxh64(text.encode(), seed=42).intdigest())


def subset(term, level):
    return (term >> (20 * level)) % imatch.RATES[level]


def words(text):
    return [spark_hash(w) for w in TERM.findall(text.lower())]


def terms(text):
    return set(words(text))


def codes(text, seen, common):
    """(subset, hash of its sorted terms) of the terms in the band, or of those that stand for them."""
    own = terms(text)
    above = [h for h in common if h in own]
    kept = {h for h in own if seen.get(h, 0) >= imatch.LEAST_DOCS} - set(common)
    kept = kept or {h for h in own if seen.get(h, 0) < imatch.LEAST_DOCS} or set(above[: imatch.RAREST])
    subsets = {}
    for h in kept:
        for level in (0, 1):
            if subset(h, level) < imatch.SUBSETS:
                part = h & (1 << imatch.TERM_BITS) - 1 | 1
                subsets.setdefault(subset(h, level) + level * imatch.SUBSETS, []).append(part)
    digest = lambda parts: spark_hash("".join(f",{p}" for p in sorted(parts))) & (1 << imatch.DIGEST_BITS) - 1
    return {k: digest(parts) for k, parts in subsets.items()}


def fingerprint(text, found):
    if not found:
        return f"text:{spark_hash(text) & (1 << 64) - 1:X}"
    return "-".join(f"{(k << imatch.DIGEST_BITS) + found[k]:X}" for k in sorted(found))


def likeness(a, b):
    best = 0.0
    for level in (0, 1):
        one, other = ({k: v for k, v in c.items() if k // imatch.SUBSETS == level} for c in (a, b))
        either = one.keys() | other.keys()
        best = max(best, len(one.items() & other.items()) / len(either) if either else 0.0)
    return best


def brute(rows, common):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    seen = {}
    for _, text in rows:
        for h in terms(text):
            seen[h] = seen.get(h, 0) + 1
    known = [r for r in rows if r[0] is not None]
    out = []
    for k, (doc, text) in enumerate(rows):
        after = known[(k + 1) % len(known)][1] if doc is not None else None
        half = len(text) // 2
        edited = text[: len(text) - half] + (after or "")[:half]
        own, new = codes(text, seen, common), codes(edited, seen, common)
        near_edited = 1.0 if fingerprint(text, own) == fingerprint(edited, new) else likeness(own, new)
        near_next = 0.0
        if after is not None:
            following = codes(after, seen, common)
            near_next = 1.0 if fingerprint(text, own) == fingerprint(after, following) else likeness(own, following)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc, len(text), digest, fingerprint(text, own), fingerprint(edited, new), round(near_edited, 9), round(near_next, 9)))
    return sorted(out, key=str)


def shares(texts):
    """The number of signatures, and for each term that of the texts it is in."""
    signed, every = {}, set()
    for text in texts:
        hashed = words(text or "")
        runs = [hashed[i : i + imatch.SHINGLE] for i in range(max(1, len(hashed) - imatch.SHINGLE + 1))]
        sign = min(spark_hash_all(run) for run in runs) if hashed else 0
        every.add(sign)
        for h in hashed:
            signed.setdefault(h, set()).add(sign)
    return len(every), {h: len(s) for h, s in signed.items()}


def spark_hash_all(values):
    """Spark's hash of a list of longs: each is hashed with the hash before it as the seed."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64((v & (1 << 64) - 1).to_bytes(8, "little"), seed=seed & (1 << 64) - 1).intdigest()
    return signed(seed)


def check(docs):
    """The result, compared with brute force; the terms above the band are checked in a test of their own."""
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    common = imatch.common_terms(docs, imatch.lexicon(docs)).first()["common"]
    found = imatch.compare(docs).collect()
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in found), key=str) == brute(rows, common)
    return found


def test_whole_table_against_brute_force(spark, sf_dir):
    found = check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    mean = lambda name: sum(r[name] for r in found) / len(found)
    assert mean("near_edited") > 0.2 > 0.05 > mean("near_next")


def test_sparse_and_negative_ids(frame):
    check(frame([(i, f"some words {i % 7} of text number {i} " * (1 + abs(i) % 5)) for i in (-5000, -513, -512, -1, 0, 3, 511, 512, 90_000, 1 << 40)]))


def test_edges(edges, nothing, frame):
    assert imatch.compare(nothing).collect() == []
    check(frame([(5, "only one document")]))
    check(edges)


def test_every_term_of_the_lexicon_counts(frame):
    """Short texts have subsets, and texts that differ in one term differ."""
    words = [f"term{k}" for k in range(60)]
    rows = [(k, " ".join(words[k : k + 12])) for k in range(48)] + [(100, " ".join(words[:11]))]
    found = {r["doc_id"]: r for r in check(frame(rows))}
    assert not any(r["fingerprint"].startswith("text:") for r in found.values())
    assert len({r["fingerprint"] for r in found.values()}) == len(rows)
    assert all(found[k]["near_next"] > 0.6 for k in range(1, 48))


def test_terms_above_the_band(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r["text"] for r in docs.select("text").collect()]
    seen = {r["term"]: r["docs"] for r in imatch.lexicon(docs).collect()}
    common = imatch.common_terms(docs, imatch.lexicon(docs)).first()["common"]
    assert common == sorted(common, key=lambda h: (seen[h], h))
    total, signed = shares(texts)
    for h, rows in seen.items():
        share = min(rows / len(texts), signed[h] / total)
        if abs(share - imatch.MOST_SHARE) > 4 * imatch.ERROR * imatch.MOST_SHARE:  # the count of signatures is approximate
            assert (h in common) == (share > imatch.MOST_SHARE)


def test_a_group_of_copies_keeps_its_terms(frame):
    """A third of the rows are near copies: their fingerprints are of their terms and alike."""
    draw = random.Random(6)
    base = [f"hot{k}" for k in range(200)]
    rows = []
    for i in range(60):
        text = list(base)
        for k in range(4):
            text[(i * 7 + k * 50) % 200] = f"edit{i % 5}x{k}"
        rows.append((3 * i, " ".join(text)))
        rows += [(3 * i + j, " ".join(f"w{draw.randrange(600)}" for _ in range(120))) for j in (1, 2)]
    found = {r["doc_id"]: r for r in check(frame(rows))}
    near = [found[3 * i]["near_edited"] for i in range(60)]
    assert not any(r["fingerprint"].startswith("text:") for r in found.values())
    assert min(near) > 0 and sum(near) / len(near) > 0.2


def test_texts_of_common_or_rare_terms_only(frame):
    """They have fingerprints of their rarest terms."""
    rows = [(k, f"the of and {'to in' if k % 2 else 'at on'} own{k} own{k}b shared{k % 9}") for k in range(40)]
    found = {r["doc_id"]: r for r in check(frame([*rows, (90, "the of and"), (91, "the of and"), (92, "never seen before")]))}
    assert found[90]["fingerprint"] == found[91]["fingerprint"]
    assert not any(r["fingerprint"].startswith("text:") for r in found.values())


def test_native_plan(spark, frame):
    """No Python, and the texts are shuffled once: both uses of the dealt rows read one exchange."""
    found = imatch.compare(frame([(k, f"a b {k}") for k in range(20)]))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert not re.search("Python|Pandas|Arrow", plan)
    dealt = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 3 and sum("ReusedExchange" not in line for line in dealt) == 1


def test_buckets_follow_the_ids(spark):
    """Any spread of ids is cut into buckets in order, of about as many rows each."""
    ids = [(-(1 << 62), ), *((k * k * k,) for k in range(5000)), *((1 << 40 | k,) for k in range(5000)), (None,)]
    docs = spark.createDataFrame(ids, "doc_id long")
    bucket = imatch.bucketing(docs)
    rows = docs.select("doc_id", bucket(F.col("doc_id"), F.lit(-7).cast("long")).alias("b")).collect()
    known = sorted((r["doc_id"], r["b"]) for r in rows if r["doc_id"] is not None)
    assert [b for _, b in known] == sorted(b for _, b in known)
    assert max(Counter(b for _, b in known).values()) < 60
