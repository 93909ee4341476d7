"""Preference formatting against a direct implementation, and a plan without Python."""

import random

from cograph.llm import preference
from cograph.llm.queries import OP9_SQL, op9_preference
from cograph.oracle_check import compare, duck

SPEC = "conv_id long, turn long, role string, text string, chosen string"


def direct(rows):
    convs = {}
    for c, turn, role, text, _ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or "", role or "user", text or ""))
    convs = {c: [(t[6], t[7]) for t in sorted(ts)] for c, ts in convs.items()}
    last = {c: max((i for i, t in enumerate(ts) if t[0] == "assistant"), default=None) for c, ts in convs.items()}
    show = lambda t: f"<|im_start|>{t[0]}\n{t[1]}<|im_end|>\n"

    def mask(turns):
        at, out = 0, []
        for t in turns:
            if t[0] == "assistant":
                out.append([at + len(f"<|im_start|>{t[0]}\n"), at + len(show(t)) - 1])
            at += len(show(t))
        return out

    for c, ts in convs.items():
        other = list(ts)
        if last[c] is not None:
            other = ts[:last[c]]
            if last.get(c ^ 1) is not None:
                other.append(convs[c ^ 1][last[c ^ 1]])
        n = 0
        while n < min(len(ts), len(other)) and ts[n] == other[n]:
            n += 1
        a, b = ts[n:], other[n:]
        yield c, n, "".join(map(show, ts[:n])), "".join(map(show, a)), "".join(map(show, b)), mask(a), mask(b), len(a), len(b), bool(a or b)


def table():
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant"]) if t else "user", r.choice(["hi", "né", "", "long " * 50, "x\ny"]), "clash") for c in range(40) if c % 7 for t in range(r.randint(1, 6))]
    rows += [(100, 0, "user", "q", "c"), (100, 1, "assistant", "same", "c"), (101, 0, "user", "other", "c"), (101, 1, "assistant", "same", "c"),
             (200, 0, "user", "only", "c"), (202, None, None, None, "c"), (202, 0, "system", None, "c"), (None, 0, "user", "lost", "c"),
             (204, 0, "user", "t", "c"), (204, 1, "assistant", "a", "c"), (204, 1, "assistant", "a", "c"), (205, 0, "assistant", "z" * 100_000, "c")]
    return rows


def got(df):
    return sorted((r.pair_id, r.prompt_turns, r.prompt, r.chosen, r.rejected, [list(x) for x in r.chosen_mask], [list(x) for x in r.rejected_mask], r.n_chosen, r.n_rejected, r.informative) for r in df.collect())


def test_matches_direct_implementation(spark):
    df = spark.createDataFrame(table(), SPEC).repartition(4)
    pairs = preference.format_pairs(*preference.mismatched_replies(df))
    assert got(pairs) == sorted(direct(table()))


def test_masked_spans_are_the_replies(spark):
    df = spark.createDataFrame([r for r in table() if r[0] is not None and 90 < r[0] < 102], SPEC)
    r = preference.format_pairs(*preference.mismatched_replies(df)).filter("pair_id = 100").first()
    assert not r.informative and r.chosen == "" and r.prompt.count("<|im_start|>") == 2
    one = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "good")], "pair_id long, position int, role string, text string")
    two = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "bad")], "pair_id long, position int, role string, text string")
    r = preference.format_pairs(one, two).first()
    assert r.chosen[slice(*r.chosen_mask[0])] == "good<|im_end|>" and r.rejected[slice(*r.rejected_mask[0])] == "bad<|im_end|>" and r.prompt == "<|im_start|>user\nq<|im_end|>\n"


def test_no_rows(spark):
    assert preference.format_pairs(*preference.mismatched_replies(spark.createDataFrame([], SPEC))).collect() == []


def test_no_python_in_the_plan_and_same_as_sql(spark):
    d = "/root/testdata/sf0.001"
    df = op9_preference(spark, d)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))
    ok, message = compare(df, duck(d), OP9_SQL)
    assert ok, message
