"""Filter audit, power-of-two packing and conversation repair against plain Python."""

import hashlib
import heapq
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from pulsekit.llm.binary_packing import ByteEncoder, binary_lengths, binary_packing, bucketed
from pulsekit.llm.conversation_repair import (
    auction, block_arcs, block_prices, cheapest_edits, damaged, judged, repair_conversations, repaired_turns, structure)
from pulsekit.llm.filter_audit import failure_sets, filter_audit, lattice_edges, path_counts
from tests.conftest import SF001
from tests.llm.test_texts import ODD, docs

BYTE = P.path("byte_bpe_50k.json")


# --- filter audit

def fails(text, doc_id, firsts):
    text = text or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
    tests = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
             bool(re.search("[#$%&*|]", text)), doc_id is not None and firsts.get(text) is not None and firsts[text] < doc_id)
    return {f for f, bad in zip("ABCDE", tests) if bad}


def brute_audit(rows, labels):
    """Every order walked document by document."""
    firsts, parts, good, toxic = {}, defaultdict(list), set(), set()
    for i, text, _ in rows:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    for i, q, t in labels:
        good |= {i} if q == 1 and i is not None else set()
        toxic |= {i} if t == 1 and i is not None else set()
    for i, text, lang in rows:
        parts[lang or ""].append((i, fails(text, i, firsts)))
    out, sums = {}, Counter()
    for part, members in parts.items():
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                early = set(order[:step - 1])
                gone = [(i, x) for i, x in members if f in x and not x & early]
                out[part, order, step] = (
                    sum(not x & (early | {f}) for _, x in members), len(gone), sum(f in x and bool(x & early) for _, x in members),
                    sum(x == {f} for _, x in members), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                sums[part, f] += len(gone)
    return {(p, o, s): (*v, sums[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_path_counts():
    forward, backward = path_counts(4)
    fact = [1, 1, 2, 6, 24]
    assert all(forward[s] == fact[s.bit_count()] and backward[s] == fact[4 - s.bit_count()] for s in range(16))


def audit_frames(spark, rows, labels):
    return (spark.createDataFrame([(i, t, la, 1, "x", 7) for i, t, la in rows],
                                  "doc_id long, text string, lang string, n int, part string, fails int"),
            spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, part string"))


def test_audit_against_every_order(spark):
    rng = random.Random(1)
    texts = ["", None, "a " * 300, "AB c " * 10, "x#", "one two three", " ".join(f"w{i}" for i in range(250)),
             " ".join(f"W{i}" for i in range(210)) + " $", "é b", "word " * 200_000]
    rows = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice(["en", "", None, "de"])) for _ in range(300)]
    rows += [(5, "copy", "en")] * 40 + [(i, "copy", "fr") for i in range(40)]
    labels = [(rng.randrange(40), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)] + [(None, 1, 1)]
    d, la = audit_frames(spark, rows, labels)
    got = filter_audit(d, la).collect()
    want = brute_audit(rows, labels)
    assert len(got) == len(want) == 600 * 4
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want
    assert filter_audit(d.limit(0), la).collect() == [] and len(filter_audit(d, la.limit(0)).collect()) == 2400


def test_audit_edges_balance(spark):
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    sets = failure_sets(table, spark.read.parquet(f"{SF001}/labels.parquet"))
    edges = lattice_edges(sets).collect()
    assert sum(r.n for r in sets.collect()) == table.count()
    by = defaultdict(int)
    for r in edges:
        assert r.removed >= r.good_lost and r.removed >= r.toxic_lost and r.removed >= r.unique_fails
        by[r.part, r.filter] += r.removed * r.orders
    assert all(by[r.part, r.filter] == r.shapley for r in edges)


# --- power-of-two packing

def test_binary_lengths():
    assert binary_lengths(1) == [1] and binary_lengths(3000) == [1024, 1024, 512, 256, 128, 32, 16, 8]
    assert all(sum(binary_lengths(n, 8)) == n for n in range(100)) and binary_lengths(0) == []


def check_pieces(rows, texts, tok):
    """Ids of the library, each once; sequences of one piece, numbered by bucket without gaps."""
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        assert r.offset == 0 and r.length == 1 << r.bucket <= 1024
    ordered = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in ordered] == list(range(len(rows)))
    assert [r.bucket for r in ordered] == sorted(r.bucket for r in rows)
    for doc, text in texts.items():
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids) and len(by[doc]) == len(binary_lengths(len(ids)))
    assert set(by) == set(texts)


def library():
    tok = Tokenizer.from_file(BYTE)
    tok.no_truncation()
    tok.no_padding()
    return tok


def test_pieces_of_odd_texts_and_the_table(spark):
    tok = library()
    odd = [*ODD, "<|endoftext|>", "a<|endoftext|> b", "  x" * 700, "\n" * 3000, "don't 'LL we'll 1½² ​﻿", "é" * 1023]
    check_pieces(binary_packing(docs(spark, odd), BYTE).collect(), dict(enumerate(odd)), tok)
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    check_pieces(binary_packing(table, BYTE).collect(), {r.doc_id: r.text for r in table.collect()}, tok)


def test_encoder_against_the_library():
    tok, enc, rng = library(), ByteEncoder(BYTE), random.Random(3)
    signs = list("abcdeXYZ019  \n\t.,'!-é漢😀́\x1c\x85 　") + ["'s", "'ll", "<|endoftext|>", " the", "\r\n"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(60))) for _ in range(3000)]
    for t, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        assert enc.encode(t).tolist() == e.ids, t
    run = " " * 3_000_000 + "a"  # the fast library gives up here
    start = time.process_time()
    assert len(enc.encode(run)) > 0 and enc.slow is not None and time.process_time() - start < 60


def test_repeated_pieces_and_nothing(spark):
    same = docs(spark, ["a b c"] * 50 + [None] * 3, [1] * 50 + [None] * 3).withColumnRenamed("kind", "bucket")
    rows = binary_packing(same, BYTE, keep_ids=True).collect()
    assert Counter(r.length for r in rows) == {4: 50, 1: 3}
    assert sorted(r.sequence_id for r in rows) == list(range(53)) and all(len(r.ids) == r.length for r in rows)
    assert binary_packing(same.limit(0), BYTE).collect() == []
    with pytest.raises(ValueError):
        binary_packing(same, BYTE, longest=1000)


def test_buckets_are_ranges(spark):
    pieces = spark.range(5000).selectExpr("id as doc_id", "0L as start", "if(id % 3 = 0, 512L, 1L) as length",
                                          "id as ids_crc32", "1L as doc_tokens")
    rows = bucketed(pieces).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(5000))
    assert max(r.sequence_id for r in rows if r.length == 1) < min(r.sequence_id for r in rows if r.length == 512)


# --- conversation repair

def brute_edits(codes):
    """Cheapest edits by a search ordered by (cost, audit)."""
    n, queue, seen = len(codes), [(0, "", 0, "")], set()
    while queue:
        cost, audit, i, out = heapq.heappop(queue)
        state = "" if not out else out[-1]
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == n and state in ("", "a"):
            return cost, audit
        wanted = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        moves = [("I", 2, i, wanted)]
        if i < n:
            code, cut = codes[i], codes[i].isupper()
            moves.append(("D", 3, i + 1, state))
            if code != "-":
                moves.append(("R", 2 + cut, i + 1, wanted))
                if code.lower() == wanted or code.lower() == "s" and not state:
                    moves.append(("K", cut, i + 1, code.lower()))
        for edit, c, j, last in moves:
            heapq.heappush(queue, (cost + c, audit + edit, j, last))


def test_cheapest_edits_against_a_search():
    rng = random.Random(5)
    for k in range(1500):
        codes = "".join(rng.choices("suaxSUAX-", k=rng.randrange(0, 13 if k % 3 else 40)))
        for block in (1, 3, 16):
            assert cheapest_edits(codes, block) == brute_edits(codes), (codes, block)
    assert cheapest_edits("") == (0, "") and cheapest_edits("s") == (3, "D") and cheapest_edits("a") == (2, "IK")


def test_converged_prices():
    arcs = block_arcs("uuS-axU", None)
    prices = [0] * len(arcs)
    auction(arcs, prices, 0)
    assert prices[0] == brute_edits("uuS-axU")[0] and prices[-1] == 0
    assert all(prices[i] <= cost + prices[j] for i, out in enumerate(arcs) for _, cost, j in out)
    assert block_prices("uuS-axU", None)[:4][0] == prices[0]


def test_a_long_conversation_takes_linear_time():
    rng, spent = random.Random(2), []
    for n in (20_000, 80_000):
        codes = "".join(rng.choices("uaUA-xs", k=n))
        start = time.process_time()
        cost, audit = cheapest_edits(codes)
        spent.append(time.process_time() - start)
        assert sum(c in "DKR" for c in audit) == n and cost > 0
    assert spent[1] < 60 and spent[1] < 8 * spent[0] + 1


def brute_conversations(rows):
    shown = lambda v: " " if v is None else str(v)
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text, copies = shown(role), shown(text), 1
        k = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        convs[conv]
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        convs[conv] += [(turn, "user" if k == 4 else role, text)] * (1 + (k == 3))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, counts, codes = set(), Counter(), ""
        for _, role, text in turns:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not core else "duplicate" if (role, text) in seen else
                     "truncated" if core[-1] not in ".!?" else "none")
            seen.add((role, text))
            counts[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("blank", "duplicate") else code.upper() if fault == "truncated" else code
        numbers = [t for t, _, _ in turns if t is not None]
        cost, audit = brute_edits(codes)
        final, k = [], 0
        for edit in audit:
            before = final[-1][0][:1] if final else ""
            wanted = "assistant" if before == "u" else "user"
            if edit == "I":
                final.append((wanted, ""))
                continue
            _, role, text = turns[k]
            k += 1
            if edit != "D":
                final.append((role if edit == "K" else wanted, text))
        initials = [r[:1] for _, r, _ in turns]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, counts["blank"], counts["duplicate"],
                     counts["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in final).encode()).hexdigest())
    return out


def compare_conversations(spark, rows):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn long, role string, text string, audit string, n int")
    got = repair_conversations(df).collect()
    want = brute_conversations(rows)
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want


def test_conversations_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare_conversations(spark, rows)


def test_made_up_conversations(spark):
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "", None, "ux", "User", "éa"]
    texts = ["Hello.", "What?", "no end", "", None, " \n\t", "end. ", "é! \x0c", "a ", "Bye! ", "x" * 50_000 + "."]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, -3, *range(12)]), rng.choice(roles), rng.choice(texts))
            for _ in range(900)]
    rows += [(100, 3, "user", "Hello.")] * 300 + [(101, i, "user", "Same.") for i in range(400)]
    drop = next(i for i in range(1000, 5000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    compare_conversations(spark, rows + [(drop, 0, "user", "gone.")])
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair_conversations(none).collect() == []


def test_repaired_turns(spark):
    rows = judged(damaged(spark.read.parquet(f"{SF001}/conversations.parquet"))).cache()
    plans = structure(rows)
    convs = defaultdict(list)
    for r in sorted(repaired_turns(rows, plans).collect(), key=lambda r: (r.conv_id, r.turn)):
        assert r.turn == len(convs[r.conv_id])
        convs[r.conv_id].append(r.role[0])
    assert convs and all(re.fullmatch("s?(ua)+", "".join(x)) for x in convs.values())
