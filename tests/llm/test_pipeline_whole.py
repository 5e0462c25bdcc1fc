"""The pipeline's stages do the whole job: planted near copies, null and repeated ids."""

import random

import corpus_pipeline
import pytest
from docloom.llm import set_similarity
from docloom.llm.common import table

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def sets(t, width=5):
    w = (t or "").lower().split()
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def classes(texts):
    """Brute force: least index connected at Jaccard 0.8."""
    s = [sets(t) for t in texts]
    root = list(range(len(s)))
    near = [(i, j) for i, x in enumerate(s) for j, y in enumerate(s[:i]) if x == y or 5 * len(x & y) >= 4 * len(x | y)]
    while any(root[i] != root[j] for i, j in near):
        for i, j in near:
            root[i] = root[j] = min(root[i], root[j])
    return root


@pytest.mark.parametrize("group", [6, 90])
def test_near_copies_at_similarity(spark, group):
    r = random.Random(5)
    word = lambda: r.choice("abcdefgh") + str(r.randrange(300))
    texts, line = [None, "", "one", "ONE", "one two three"], " ".join(word() for _ in range(12))
    for size in (8, 40, 150, 900):
        base = [word() for _ in range(size)]
        texts.append(" ".join(base))
        for k in range(group if size == 150 else 6):
            w = list(base)
            for _ in range(max(1, size * (k % 6) // 110)):
                w[r.randrange(size)] = word()
            texts.append(" ".join(w))
    texts += [" ".join(word() for _ in range(30)) + " " + line for _ in range(80)]
    want = classes(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOC).repartition(3)
    got = {}
    for x in set_similarity.similar_classes(docs).collect():
        got.setdefault(x["class"], []).append(x.doc_id)
    mine = {i: min(v) for v in got.values() for i in v}
    assert [mine[i] for i in range(len(texts))] == want
    kept = [x.text for x in dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, "").collect()]
    assert len(set(classes(kept))) == len(kept)


def test_near_stage_leaves_no_similar_pair(spark, sf):
    out = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, table(spark, sf, "documents"), sf)
    kept = [x.text for x in out.collect()]
    assert len(kept) == 187 and len(set(classes(kept))) == len(kept)
    assert set_similarity.similar_classes(spark.createDataFrame([], DOC)).count() == 0


def test_stages_with_null_and_repeated_ids(spark, sf):
    """The same texts under null or repeated ids meet the same end as under unique ones."""
    benchmark = [x.text for x in table(spark, sf, "benchmark").limit(3).collect()]
    some = table(spark, sf, "documents").limit(30).collect()
    clean = [(x.text, x.lang, x.source, x.n_chars) for x in some]
    dirty = [(t, "en", "s", 1) for t in ("mail me@example.org now", "host 10.1.2.3 up", *benchmark)]
    texts = clean + dirty + clean[:5]
    stages = dict(corpus_pipeline.STAGES)

    def table_of(ids):
        return spark.createDataFrame([(i, *t) for i, t in zip(ids, texts)], DOC).repartition(3)

    unique = table_of(range(10**6, 10**6 + len(texts)))
    for ids in ([None] * len(texts), [10**6] * len(texts)):
        for name in ("quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii"):
            want = sorted(str(x.text) for x in stages[name](spark, unique, sf).collect())
            got = stages[name](spark, table_of(ids), sf)
            assert got.columns == unique.columns
            # of similar texts the one kept goes by id
            got = sorted(str(x.text) for x in got.collect())
            assert len(got) == len(want) if name == "simhash_near_dedup" else got == want, name


def test_stages_with_odd_tables(spark, sf):
    """Empty tables, extra columns with clashing names, ties and repeated rows, for every stage."""
    from pyspark.sql import functions as F

    stages = corpus_pipeline.STAGES
    empty = spark.createDataFrame([], DOC)
    some = table(spark, sf, "documents").limit(40)
    both = some.unionByName(some)  # every row twice, so every score and length is a tie
    wide = both.withColumns({c: F.lit("clash") for c in ("row", "d", "th", "ws", "spans", "slots", "score", "kept", "class", "component_id", "piece", "length")})
    for name, stage in stages:
        assert stage(spark, empty, sf).count() == 0, name
        plain, clash = stage(spark, both, sf), stage(spark, wide, sf)
        assert plain.columns == clash.columns and plain.count() == clash.count(), name
        if name != "best_fit_packing":
            assert clash.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert dict(stages)["simhash_near_dedup"](spark, both, sf).count() == dict(stages)["simhash_near_dedup"](spark, some, sf).count()
    assert dict(stages)["benchmark_decontamination"](spark, both, sf).count() == 2 * dict(stages)["benchmark_decontamination"](spark, some, sf).count()


def test_whole_chain_by_hand(spark, sf):
    """The chained result equals what plain Python makes of the classifier's documents, stage by stage."""
    import hashlib
    import re
    import zlib

    import numpy as np
    from docloom.llm import tokens

    kept = [x for x in dict(corpus_pipeline.STAGES)["quality_classifier"](spark, table(spark, sf, "documents"), sf).orderBy("doc_id").collect()]
    root = classes([x.text for x in kept])
    near = [x for i, x in enumerate(kept) if root[i] == i]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = set()
    for x in table(spark, sf, "benchmark").collect():
        w = words(x.text)
        n = min(10, len(w))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
    sizes = {len(w) for w in windows}
    hit = lambda w: any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
    clean = [x for x in near if not hit(words(x.text))]
    stages = dict(corpus_pipeline.STAGES)
    texts = {x.doc_id: x.text for x in stages["pii"](spark, spark.createDataFrame(clean, DOC), sf).collect()}
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert set(texts) == {x.doc_id for x in clean} and not any(email.search(t or "") for t in texts.values())
    assert all(texts[x.doc_id] == x.text for x in clean if not re.search(r"[0-9@]", x.text or ""))
    tok = tokens.ChunkEncoder(tokens.default_tokenizer()).tok
    want = set()
    for doc, text in texts.items():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for p, s in enumerate(range(0, len(ids), 2048)):
            part = ids[s : s + 2048]
            want.add((doc, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = corpus_pipeline.run(spark, sf).collect()
    assert {(x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got} == want, hashlib.sha256(str(len(got)).encode()).hexdigest()[:6]
    places = {}
    for x in got:
        places.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert all(sum(n for _, n in v) <= 2048 and [a for a, _ in sorted(v)] == list(np.cumsum([0, *(n for _, n in sorted(v))])[:-1]) for v in places.values())
