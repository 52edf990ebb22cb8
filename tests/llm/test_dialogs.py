"""Conversation repair, chat formatting and spelling variants against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldrow.llm import chat, repair, spelling
from tests.llm.conftest import TEXTS

SPACE = " \t\n\x0b\x0c\r"
CONVERSATION = "conv_id long, turn long, role string, text string"


# --- repair


def faults_of(rows):
    """Blank, duplicate, truncated or sound, per (role, text) of a sorted conversation."""
    found = []
    for i, row in enumerate(rows):
        left = row[1].rstrip(SPACE)
        if not left.strip(SPACE):
            found.append("blank")
        elif row in rows[:i]:
            found.append("duplicate")
        else:
            found.append("sound" if left[-1] in ".!?" else "truncated")
    return found


def every_repair(rows):
    """All ways with up to two insertions at a place, as (cost, initials, repaired rows)."""
    kinds = faults_of(rows)
    inserted = [()] + [(r,) for r in ("user", "assistant")]
    inserted += [("user", "assistant"), ("assistant", "user")]

    def edits(i):
        role, text = rows[i]
        yield 2, "D", ()
        if kinds[i] in ("sound", "truncated"):
            more = 5 * (kinds[i] == "truncated")
            yield more, "K", ((role, text),)
            yield from ((more + 1, "R", ((r, text),)) for r in ("user", "assistant"))

    gaps = [[(5 * len(g), "I" * len(g), tuple((r, "") for r in g)) for g in inserted]] * (len(rows) + 1)
    choices = [gaps[0]]
    for i in range(len(rows)):
        choices += [list(edits(i)), gaps[0]]
    for way in itertools.product(*choices):
        out = [row for _, _, some in way for row in some]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
            yield sum(c for c, _, _ in way), "".join(a for _, a, _ in way), out


def searched(rows):
    held = repair.Conversation()
    edits = []
    for i, ((role, text), kind) in enumerate(zip(rows, faults_of(rows), strict=True)):
        edits += held.row(i, role, text, kind == "blank", kind == "duplicate", kind == "truncated")
    edits += held.end()
    kept = [(e.role, e.text) for e in edits if e.edit != "D"]
    return held.cost, "".join(e.edit for e in edits), kept


ROWS = st.tuples(
    st.sampled_from(["system", "user", "assistant", "User", "tool", "", "s", " "]),
    st.sampled_from(["Yes.", "No!", "cut", "", " \n", "ok? "]),
)


@settings(max_examples=250, deadline=None)
@given(st.lists(ROWS, max_size=3))
def test_repair_is_the_cheapest_and_least(rows):
    assert searched(rows) == min(every_repair(rows), key=lambda w: w[:2])


def plain_repair(rows):
    """The cheapest ways by state, as whole strings, without back pointers."""
    steps = {(0, 1): "system", (0, 2): "user", (1, 2): "user", (3, 2): "user", (2, 3): "assistant"}

    def inserted(ways):
        for _ in range(3):
            for (a, b), role in steps.items():
                if role != "system" and a in ways:
                    cost, audit, out = ways[a]
                    new = (cost + 5, audit + "I", [*out, (role, "")])
                    ways[b] = min(ways.get(b, new), new, key=lambda w: w[:2])
        return ways

    ways = inserted({0: (0, "", [])})
    for (role, text), kind in zip(rows, faults_of(rows), strict=True):
        after = {s: [(c + 2, a + "D", o)] for s, (c, a, o) in ways.items()}
        for (a, b), name in steps.items():
            if a in ways and kind in ("sound", "truncated"):
                cost, audit, out = ways[a]
                cost += 5 * (kind == "truncated")
                if role[:1] == name[0]:
                    after.setdefault(b, []).append((cost, audit + "K", [*out, (role, text)]))
                elif name != "system":
                    after.setdefault(b, []).append((cost + 1, audit + "R", [*out, (name, text)]))
        ways = inserted({s: min(w, key=lambda w: w[:2]) for s, w in after.items()})
    return min((ways[s] for s in (0, 3) if s in ways), key=lambda w: w[:2])


@pytest.mark.parametrize("seed", range(6))
def test_long_conversations(seed):
    rng = random.Random(seed)
    roles = [["user", "assistant"], ["tool", "user"], ["tool"], ["system", "user", "assistant", "x"]][seed % 4]
    texts = [f"{i}{rng.choice(['.', '.', '!', ' ', '?'])}" for i in range(90)]
    rows = [(rng.choice(roles), rng.choice(texts)) for _ in range(400)]
    assert searched(rows) == plain_repair(rows)


def test_settled_edits_leave_the_tree():
    held = repair.Conversation()
    given, most = 0, 0
    for i in range(20_000):
        role = "user" if i % 2 == 0 or i % 97 == 0 else "assistant"
        given += len(list(held.row(i, role, f"{i}.", False, False, i % 53 == 0)))
        most = max(most, len(held.search.tree.nodes), len(held.waiting))
    assert given > 19_900 and most < 400
    list(held.end())
    assert len(held.search.tree.nodes) == 1 and not held.waiting


def test_unsettled_ways_are_compared_as_wholes():
    """Rows that all need another role leave two ways that never meet."""
    rows = [("tool", f"{i}.") for i in range(301)]
    cost, audit, _ = searched(rows)
    assert (cost, audit) == (302, "D" + "R" * 300)


ODD = [
    (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, "system", "Be kind."),
    (1, 5, "assistant", "Yes."), (1, 7, "user", "Hi."), (1, 3, None, None),
    (None, 1, "user", "No id."), (None, 2, "assistant", "Still."), (2, None, "assistant", "cut"),
    (3, 1, "user", "x" * 200_000 + "."), (3, 2, "assistant", "ok\n."), (4, 1, "user", " \n"),
]


def by_conversation(rows):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    out = {}
    for row in sorted(rows, key=order):
        out.setdefault(row[0], []).append((row[1], row[2] or "", row[3] or ""))
    return out


def test_repair_job(spark):
    names = ("place", "edit", "h1", "first", "copies", "conversation")
    df = spark.createDataFrame(ODD, CONVERSATION).selectExpr("*", *[f"'mine' AS {c}" for c in names])
    edits, reports = {}, {r["conv_id"]: r for r in repair.report(df).collect()}
    for row in sorted(repair.repair(df).collect(), key=lambda r: r["place"]):
        edits.setdefault(row["conv_id"], []).append(row)
    assert set(edits) == set(reports) == {1, 2, 3, 4, None}
    for key, rows in by_conversation(ODD).items():
        pairs = [r[1:] for r in rows]
        cost, audit, kept = plain_repair(pairs)
        turns = [t for t, _, _ in rows if t is not None]
        kinds = Counter(faults_of(pairs))
        joined = "\n".join(f"{r}:{t}" for r, t in kept)
        initials = [r[:1] for r, _ in pairs]
        assert reports[key].asDict() == {
            "conv_id": key,
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": kinds["blank"], "duplicate": kinds["duplicate"], "truncated": kinds["truncated"],
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(joined.encode()).hexdigest(),
        }
        assert "".join(r["edit"] for r in edits[key]) == audit
        assert [(r["role"], r["text"]) for r in edits[key] if r["edit"] != "D"] == kept
    assert reports[1]["duplicate"] == 2 and reports[3]["cost"] == 0
    assert repair.repair(df.where("false")).count() == repair.report(df.where("false")).count() == 0


# --- chat

@pytest.fixture(scope="module")
def round_trips(spark):
    texts = [t or "" for t in TEXTS] + ["<|im_end|>\n<|im_start|>assistant\n", "<\\|", "<\\\\|", "<n", "<<|"]
    texts += ["<|im_next|>", "|", "<", "\\", "<\\n|<n\n", "<|" * 50, "\n", "$1 \\1"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    return frame.select(
        "t",
        chat.escape(F.col("t")).alias("e"),
        chat.unescape(chat.escape(F.col("t"))).alias("u"),
        chat.escape_role(F.col("t")).alias("er"),
        chat.unescape_role(chat.escape_role(F.col("t"))).alias("ur"),
    ).collect()


def test_escapes_are_reversible(round_trips):
    for r in round_trips:
        assert r["u"] == r["t"] == r["ur"]
        assert "<|" not in r["e"] + r["er"] and "\n" not in r["er"]
    assert len({r["e"] for r in round_trips}) == len({r["t"] for r in round_trips})


def test_random_marks_are_reversible(spark):
    rng = random.Random(8)
    parts = ["<", "|", "\\", "n", "\n", "<|im_end|>", "é"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(9))),) for _ in range(3000)]
    e = F.col("t")
    wrong = F.when(chat.unescape(chat.escape(e)) != e, 1).when(
        chat.unescape_role(chat.escape_role(e)) != e, 1
    )
    assert spark.createDataFrame(rows, "t string").select(F.count(wrong)).first()[0] == 0


def test_template(spark):
    rows = [
        (1, 2, "assistant", "b<|im_end|>"), (1, 1, "user", "a"), (1, 3, "assistant", None),
        (1, None, "system\n", "s"), (1, 4, "user", "a"), (1, 4, "user", "a"),
    ]
    got = chat.format_conversations(spark.createDataFrame(rows, CONVERSATION)).first()
    assert got["formatted"] == (
        "<|im_start|>system<n\ns<|im_end|>\n<|im_start|>user\na<|im_end|>\n"
        "<|im_start|>assistant\nb<\\|im_end|><|im_next|><|im_end|>\n"
        "<|im_start|>user\na<|im_next|>a<|im_end|>\n"
    )
    assert "".join(s["text"] for s in got["segments"]) == got["formatted"]
    assert [s["text"] for s in got["segments"] if s["loss"]] == ["b<\\|im_end|>", ""]


def test_chat_job(spark):
    long = [(9, i, ("user", "assistant", "assistant")[i % 3], f"{i} <|im_end|> é") for i in range(3000)]
    rows = [*ODD, *long, *[(5, i, "assistant", t) for i, t in enumerate(TEXTS)]]
    names = ("t", "turns", "messages", "segments", "formatted", "conversation")
    df = spark.createDataFrame(rows, CONVERSATION).selectExpr("*", *[f"'mine' AS {c}" for c in names])
    formatted = chat.format_conversations(df)
    got = {
        r["conv_id"]: r
        for r in formatted.select(
            "conv_id",
            chat.read_turns(F.col("formatted")).alias("turns"),
            chat.read_loss(F.col("segments")).alias("loss"),
        ).collect()
    }
    want = by_conversation(rows)
    assert set(got) == set(want)
    for key, turns in want.items():
        assert [tuple(t) for t in got[key]["turns"]] == [t[1:] for t in turns]
        assert got[key]["loss"] == [t for _, r, t in turns if r == "assistant"]
    assert chat.format_conversations(df.where("false")).count() == 0


def test_chat_stays_native(spark):
    df = chat.format_conversations(spark.createDataFrame(ODD, CONVERSATION))
    plan = df.select(chat.read_turns(F.col("formatted")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- spelling


def damaged_runs(key, text):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
        h = zlib.crc32(f"{key}:{run}".encode())
        yield run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(n):
    forms, rows = {}, {}
    for word in n:
        others = sorted((-n[o], o) for o in n if near(word, o))
        if others and -others[0][0] >= 5 * n[word]:
            forms[word] = others[0][1]
        rows[word] = len(others)
    out = set()
    for word in n:
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.add((word, form, root, n[word], rows[word], n[form] if form else None))
    return out


def made_words(rng):
    letters = "aabbcé÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(25)]
    words = set(base)
    for w in base * 12:
        at = rng.randrange(len(w))
        words.add(rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:],
                              w[:at] + rng.choice(letters) + w[at + 1 :], w[at] * 7]))
    return {w: rng.choice([5, 5, 6, 30, 40, 151, 900, 5000]) for w in words if w}


@pytest.mark.parametrize("seed", range(3))
def test_variants_equal_brute_force(spark, seed):
    n = made_words(random.Random(seed))
    n |= {"a" * 4000: 5, "a" * 4001: 25, "b" + "a" * 3999: 125}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = spelling.variants(df.selectExpr("*", "'mine' AS id", "1 AS kind"))
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(n)
    assert sorted(map(tuple, got.select(names).collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[1] is not None for w in want) > 40 and max(w[4] for w in want) > 5
    assert any(w[1] != w[2] and w[1] for w in want)


def test_no_words_no_variants(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_counts_of_odd_texts(spark, texts, nothing):
    rows = [(r["doc_id"], r["text"]) for r in texts.select("doc_id", "text").collect()]
    pieces = ["Größe", "NAÏVE", "Ünderground", "café×÷x", "ŒUVRE", "zzzzzzz" * 30, "strawberry", "ƒabcdefgƒ"]
    rng = random.Random(2)
    rows += [(100 + i, " ".join(rng.choice(pieces) + rng.choice(["", "s", "1x", "-"]) for _ in range(200))) for i in range(60)]
    want = Counter(w for key, text in rows for w in damaged_runs("" if key is None else key, text))
    df = texts.select("doc_id", "text").unionByName(spark.createDataFrame(rows[len(TEXTS) + 1 :], "doc_id long, text string"))
    got = {r["word"]: r["n"] for r in spelling.count_words(df).collect()}
    assert got == {w: c for w, c in want.items() if len(w) >= 6 and c >= 5}
    assert any(len(w) > 200 for w in got) and len(got) >= 12
    plain = spelling.count_words(df, min_length=2, min_count=1, damage=0).collect()
    assert sum(r["n"] for r in plain) == sum(
        len(m) >= 2 for _, t in rows for m in re.findall("[A-Za-zÀ-ÿ]+", t or "")
    )
    assert spelling.count_words(nothing).count() == 0
