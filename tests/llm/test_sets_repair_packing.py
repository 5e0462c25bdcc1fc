"""Closed itemsets, conversation repair and packing in groups against brute force, with odd inputs."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from docloom.llm import conversation_repair, group_packing, itemsets
from docloom.llm.common import table
from docloom.llm.tokens import default_tokenizer

rng = random.Random(11)


# closed itemsets


def brute_closed(rows, least, share):
    held = defaultdict(set)
    for b, i, *_ in rows:
        if b is not None and i is not None:
            held[b].add(i)
    n = len(held)
    count = Counter(c for x in held.values() for k in range(1, len(x) + 1) for c in itertools.combinations(sorted(x), k))
    frequent = {c: s for c, s in count.items() if s >= least and s * share >= n}
    closed = {c: s for c, s in frequent.items() if not any(s == frequent.get(tuple(sorted({*c, i}))) for i in {j for x in held.values() for j in x} - set(c))}
    return n, frequent, closed


def told(sets):
    everywhere = tuple(sets.everywhere)
    out = {tuple(sorted((*r["items"], *everywhere))): r["support"] for r in sets.closed.collect()}
    if everywhere:
        out[everywhere] = sets.baskets
    return out


def baskets(n, width, items, skew=1.5):
    return [(b, min(items - 1, int(rng.paretovariate(skew)) - 1 + rng.randint(0, 3))) for b in range(n) for _ in range(rng.randint(1, width))]


CASES = {
    "plain": (baskets(120, 6, 12), 3, 10_000),
    "share": (baskets(120, 6, 12), 1, 20),
    "everywhere": (baskets(40, 5, 9) + [(b, 50) for b in range(40)] + [(b, 51) for b in range(40)], 4, 10_000),
    "always together": ([(b, i) for b in range(20) for i in ((1, 2, 3, 4) if b % 2 else (1, 2, 3, 9))] + [(b, 7) for b in range(3)] + [(90, 7)], 2, 10_000),
    "nulls and repeats": ([(None, 1), (1, None), (None, None), (1, 2), (1, 2), (2, 2), (3, 2), (3, 5), (2, 5)], 2, 10_000),
}


@pytest.mark.parametrize("long_basket", [64, 2])
@pytest.mark.parametrize("case", CASES)
def test_closed_itemsets(spark, case, long_basket):
    rows, least, share = CASES[case]
    df = spark.createDataFrame([(b, i, "x", 1) for b, i in rows], "basket long, item long, items string, n long")
    sets = itemsets.closed_itemsets(df, least, share, long_basket)
    n, frequent, closed = brute_closed(rows, least, share)
    assert (sets.baskets, told(sets)) == (n, closed)
    got = {(*sorted((*r["items"], *sets.everywhere)), r.c): (r.a, r.s) for r in itemsets.rules(sets).collect()}
    want = {}
    for x, s in closed.items():
        for c in x if len(x) > 1 else ():
            a, k = frequent[tuple(i for i in x if i != c)], frequent[(c,)]
            if 100 * s >= 30 * a and s * n > a * k:
                want[(*x, c)] = (a, k)
    assert got == want


def test_itemsets_of_nothing(spark):
    sets = itemsets.closed_itemsets(spark.createDataFrame([], "basket long, item long"))
    assert told(sets) == {} and itemsets.rules(sets).count() == 0


def test_itemset_query_matches_sql(spark, sf):
    want = duckdb.sql(itemsets.ORACLE["op11_key_set_itemsets"].replace("FROM sale_lines", f"FROM '{sf}/sale_lines.parquet'")).fetchall()
    cols = ("items", "n_items", "support", "n_rules", "best_item", "rules_sha256")
    got = [tuple(r[c] for c in cols) for r in itemsets.op11_key_set_itemsets(spark, sf).collect()]
    assert len(got) and sorted(map(str, got)) == sorted(map(str, want))


def test_long_baskets_emit_no_pairs(spark):
    """One basket of 3000 items that are frequent, but never together elsewhere, gives no rows of pairs."""
    rows = [(0, i) for i in range(3000)] + [(1 + i * 2 + k, i) for i in range(3000) for k in range(2)]
    sets = itemsets.closed_itemsets(spark.createDataFrame(rows, "basket long, item long"), 3, 10_000)
    assert sets.closed.count() == 3000


# conversation repair


def brute_repair(rows):
    """Cheapest (cost, audit, repaired) of rows (role, text) by the plain recurrence over suffixes."""
    seen, faults = set(), []
    for role, text in rows:
        said = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    n = len(rows)
    states = ("", "s", "u", "a")
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {}

    def option(out, state, t, cost, edit, said):
        if state is not None and (t, state) in best:
            c, audit, rest = best[t, state]
            out.append((c + cost, edit + audit, ([said] if said else []) + rest))

    for t in range(n, -1, -1):
        for s in states:
            best.pop((t, s), None)
            if t == n and s in ("", "a"):
                best[t, s] = (0, "", [])
        for _ in range(4):  # inserts stay at t
            for s in states:
                out = [best[t, s]] if (t, s) in best else []
                if t < n:
                    role, text = rows[t]
                    option(out, s, t + 1, 4, "D", None)
                    if faults[t] in ("", "truncated"):
                        more = 3 if faults[t] else 0
                        option(out, step.get((s, role[:1])), t + 1, more, "K", f"{role}:{text}")
                        for to in ("user", "assistant"):
                            option(out, step.get((s, to[0])), t + 1, 3 + more, "R", f"{to}:{text}")
                for to in ("user", "assistant"):
                    option(out, step.get((s, to[0])), t, 3, "I", f"{to}:")
                if out:
                    best[t, s] = min(out, key=lambda x: (x[0], x[1]))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *best[0, ""]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


SAID = ["Hi.", "no end", "", " \t", "What?", "ok!", "Hi.", "so\n", "é…", "x.  "]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", " ", "", "u2", None]


def test_conversation_repair(spark):
    convs = {c: [(rng.choice([None, *range(12)]) if c % 3 == 0 else t, rng.choice(ROLES if c % 2 else ROLES[:5]), rng.choice([*SAID, None, f"own {t}.", f"own {t}"])) for t in range(rng.randint(1, 14))] for c in range(300)}
    convs[None] = [(0, "user", "q?"), (1, "assistant", "a.")]
    convs[500] = [(t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(1200) if t % 97]
    convs[501] = [(t, "system", f"turn {t}") for t in range(400)]
    rows = [(c, t, r, x, False, "k", "z") for c, rs in convs.items() for t, r, x in rs] + [(900, 1, "user", "gone.", True, "k", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, gone boolean, kind string, cost string").repartition(3)
    got = {r.conv_id: r for r in conversation_repair.repair(df).collect()}
    assert set(got) == {*convs, 900}
    assert tuple(got[900])[1:] == (0, 0, 0, 0, 0, 0, "", [])
    for c, rs in convs.items():
        now = order([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rs])
        r = got[c]
        turns = {t for t, _, _ in now if t is not None}
        assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        want = brute_repair([(role, x) for _, role, x in now])
        assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, [f"{x.role}:{x.text}" for x in r.repaired]) == want, c
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[:1] for x in r.repaired))


def test_conversation_query(spark, sf):
    """The damage, row by row, and the digest."""
    convs = defaultdict(list)
    for r in table(spark, sf, "conversations").collect():
        text = " " if r.text is None else r.text
        role, kind = " " if r.role is None else r.role, zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        rows = convs[r.conv_id]
        if kind == 4:
            role = "user"
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(r.turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = conversation_repair.op12_conversation_repair(spark, sf)
    got = {r.conv_id: r for r in found.collect()}
    assert set(got) == set(convs)
    sql = duckdb.sql(conversation_repair.ORACLE["op12_conversation_repair"].replace("FROM conversations", f"FROM '{sf}/conversations.parquet'"))
    assert sql.columns == found.columns and sorted(map(str, sql.fetchall())) == sorted(str(tuple(r)) for r in got.values())
    for c, rows in convs.items():
        *counts, cost, audit, fixed = brute_repair([(role, x) for _, role, x in order(rows)])
        r = got[c]
        assert ([r.blank, r.duplicate, r.truncated, r.illegal], r.cost, r.audit, r.repaired_sha256) == (counts, cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest())


def test_layers_are_linear():
    codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 8]) for _ in range(20_000))
    layers = conversation_repair.Layers(codes)
    assert sum(map(len, layers.bits)) <= 12 * (len(codes) + 1) and len(layers.audit()) >= len(codes)


def test_conversations_of_nothing(spark):
    assert conversation_repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string, gone boolean")).count() == 0


# packing in groups


@pytest.mark.parametrize("capacity", [8, 64])
def test_first_fit_decreasing(capacity):
    for _ in range(30):
        lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randint(1, 80))])
        rooms, want = [], {}
        for i in np.argsort(-lengths, kind="stable").tolist():
            k = next((k for k, r in enumerate(rooms) if r >= lengths[i]), len(rooms))
            if k == len(rooms):
                rooms.append(capacity)
            rooms[k] -= lengths[i]
            want[i] = k
        assert dict(enumerate(group_packing.first_fit_decreasing(lengths, capacity).tolist())) == want


def check_packed(rows, texts, capacity, tokenizer):
    """Every id in one piece, sequences gapless and never padded."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append(r)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
    assert len(documents) == len(texts)
    for d, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(documents[d], key=lambda r: r.start):
            piece = ids[r.start : r.start + r.length]
            assert r.start == at and r.doc_tokens == len(ids)
            assert (r.ids_crc32 if "ids_crc32" in r else zlib.crc32(r["ids"])) == zlib.crc32(piece.tobytes())
            at += r.length
        assert at == len(ids)
    return sequences


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def test_pack_in_groups(spark, tokenizer):
    said = lambda n: " ".join(rng.choice(("the", "river", "ран", "42", "naïve", "quick—brown")) for _ in range(n))
    texts = dict(enumerate([None, "", " \n", "one", said(9000), *[said(rng.randint(1, 60)) for _ in range(150)], *[said(30)] * 5, "<|endoftext|> x"]))
    texts[None] = said(20)
    df = spark.createDataFrame([(d, t, 1, "y") for d, t in texts.items()], "doc_id long, text string, part long, whole string").repartition(3)
    for group_tokens in (1 << 22, 500):
        rows = group_packing.pack_in_groups(df, capacity=64, group_tokens=group_tokens).collect()
        check_packed(rows, texts, 64, tokenizer)
    twice = group_packing.pack_in_groups(df.unionByName(df), capacity=64).collect()
    assert sum(r.length for r in twice) == 2 * sum(r.length for r in rows)
    assert group_packing.pack_in_groups(df.limit(0)).count() == 0


def test_packing_query(spark, sf, tokenizer):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    rows = group_packing.op13_first_fit_packing(spark, sf).collect()
    sequences = check_packed(rows, texts, 4096, tokenizer)
    # no more than one document is cut for each sequence
    assert sum(r.length < r.doc_tokens <= 4096 for r in rows) <= 2 * len(sequences)
