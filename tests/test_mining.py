import random
from difflib import SequenceMatcher, get_close_matches

import pytest
from pyspark.sql import functions as F

from conftest import one_column, results
from talweg.functions import text as t
from talweg.operators import domains as d
from talweg.operators import fuzzy as fz
from talweg.operators import mining as m


def sequential_autofix(spark, invalid, accepted):
    """One value after another, as a person would do it."""
    every = sorted({v for v, _ in invalid} | set(accepted))
    frame = one_column(spark, every)
    norm = dict(zip(every, results(frame, t.rule_key(F.col("v")))))
    repaired = dict(zip(every, results(frame, t.repair_mojibake(F.col("v")))))
    extra = sorted({r for r in repaired.values() if r})
    if extra:
        norm.update(zip(extra, results(one_column(spark, extra), t.rule_key(F.col("v")))))
    known = every + extra
    stem = dict(zip(known, results(one_column(spark, known), t.alias_stem(F.col("v")))))
    broken = dict(zip(every, results(frame, t.looks_like_mojibake(F.col("v")))))
    values, aliases, out = list(accepted), {}, set()
    for value, _ in sorted(invalid, key=lambda p: (-p[1], p[0])):
        taken = {norm[a]: a for a in values}
        if norm[value] in taken or norm[value] in {norm[a] for a in aliases}:
            continue
        if broken[value]:
            fixed = repaired[value]
            if not fixed:
                continue
            target = taken.get(norm[fixed], fixed)
            if norm[fixed] not in taken:
                values.append(fixed)
                out.add(("accepted", fixed, fixed))
            aliases[value] = target
            out.add(("alias", value, target))
            continue
        near = [a for a in values if stem[a] == stem[value]] if stem[value] else []
        if len(near) == 1:
            aliases[value] = near[0]
            out.add(("alias", value, near[0]))
        else:
            values.append(value)
            out.add(("accepted", value, value))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_autofix_equals_one_by_one(spark, seed):
    rng = random.Random(seed)
    words = ["rio", "lago", "serra", "ação", "monte", "ção", "da", "de"]
    pool = set()
    while len(pool) < 60:
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 2)))
        text = rng.choice(["", "APP_", "do "]) + text + rng.choice(["", "s", "S"])
        pool.add(rng.choice([text, text.upper(), text.encode().decode("latin-1"), text.title()]))
    pool = sorted(pool)
    rng.shuffle(pool)
    accepted, candidates = pool[:12], pool[12:]
    norms = dict(zip(pool, results(one_column(spark, pool), t.rule_key(F.col("v")))))
    accepted = list({norms[a]: a for a in accepted}.values())
    clean = [v for v in accepted if "Ã" not in v]
    taken = {norms[a] for a in clean}
    invalid = [(v, rng.randint(1, 5)) for v in candidates if norms[v] not in taken]
    frame = spark.createDataFrame([("c", v, n) for v, n in invalid], "column string, value string, n long")
    base = spark.createDataFrame([("c", v) for v in clean], "column string, canonical string")
    got = {(r.kind, r.value, r.canonical) for r in m.autofix_domain(frame, base).collect()}
    assert got == sequential_autofix(spark, invalid, clean)


def test_autofix_fixtures(spark):
    broken = "PARQUE NACIONAL DO TAPAJÃ\u0093S"
    invalid = spark.createDataFrame([("c", broken, 2)], "column string, value string, n long")
    none = spark.createDataFrame([], "column string, canonical string")
    known = spark.createDataFrame([("c", "PARQUE NACIONAL DO TAPAJÓS")], "column string, canonical string")
    fixed = ("alias", broken, "PARQUE NACIONAL DO TAPAJÓS")
    assert {(r.kind, r.value, r.canonical) for r in m.autofix_domain(invalid, known).collect()} == {fixed}
    assert {(r.kind, r.value, r.canonical) for r in m.autofix_domain(invalid, none).collect()} == {
        fixed, ("accepted", "PARQUE NACIONAL DO TAPAJÓS", "PARQUE NACIONAL DO TAPAJÓS")}


def test_generated_domain(spark):
    frame = spark.createDataFrame([("Ilheus ¿ Itabuna",), (" Cacoal ",), ("Cacoal",), ("naÃ§Ã£o",), ("",), (None,)], "v string")
    got = {tuple(r) for r in m.generate_domain(frame, "v").collect()}
    assert got == {("accepted", "Ilheus - Itabuna", "Ilheus - Itabuna"), ("alias", "Ilheus ¿ Itabuna", "Ilheus - Itabuna"),
                   ("accepted", "Cacoal", "Cacoal"), ("accepted", "nação", "nação"), ("alias", "naÃ§Ã£o", "nação")}


def test_mined_relation(spark):
    frame = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", "bad"), ("d", "X "), ("e", None)],
                                  "s string, t string")
    values = spark.createDataFrame([("x", 0), ("y", 1)], "canonical string, position int")
    aliases = spark.createDataFrame([], "alias string, canonical string, position int")
    existing = spark.createDataFrame([("s_to_t", "z"), ("other", "a")], "relation string, src_value string")
    lookups = d.domain_lookup(values, aliases, []).withColumn("column", F.lit("t"))
    mined = m.mine_relations(frame, [("s_to_t", "s", "t"), ("t_to_s", "t", "s")], lookups, ["t"], existing)
    assert {tuple(r) for r in mined.collect()} == {("s_to_t", "a", "x"), ("s_to_t", "d", "x"), ("t_to_s", "y", "b"), ("t_to_s", "x", "d")}
    counts = d.invalid_value_counts(frame.withColumn("u", F.upper("t")), lookups.unionByName(lookups.withColumn("column", F.lit("u"))), ["t", "u"])
    assert {tuple(r) for r in counts.collect()} == {("t", "bad", 1), ("u", "BAD", 1)}
    # One scan of the layer, and values and aliases of each of the two lookups.
    assert counts._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1 + 2 * 2
    dependency = m.functional_dependency(frame, m.clean_value(F.col("s")), m.clean_value(F.col("t")), "n").collect()
    assert {(r.src_value, r.dst_value) for r in dependency if r.ambiguous} == {("b", "x"), ("b", "y")}


def greedy(values, cutoff=0.9):
    """Sequential canonicalisation with the standard library's matcher."""
    norms, canon, out = [], [], {}
    for value in values:
        norm = "".join(c for c in value if ord(c) < 128).upper()
        close = get_close_matches(norm, norms, n=1, cutoff=cutoff) if norm else []
        if close:
            out[value] = canon[norms.index(close[0])]
            continue
        if norm:
            norms.append(norm)
            canon.append(value)
        out[value] = value
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_fuzzy_mapping_equals_greedy(spark, seed):
    rng = random.Random(seed)
    stems = ["reserva legal averbada", "area de uso restrito", "abc", "parque nacional do rio", "xy"]
    values = []
    for _ in range(150):
        text = list(rng.choice(stems))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randint(0, 1)] = rng.choice("abcxyz ")
        values.append("".join(text).strip() or "z")
    values += [v.upper() for v in values[::3]] + [v + "日" for v in values[1::3]]  # other spellings of one text
    values = list(dict.fromkeys(values)) + ["日本"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.value: r.replacement for r in fz.fuzzy_mapping(frame, "v", "i").collect()}
    assert got == greedy(values)


def test_candidate_pairs_lose_nothing(spark):
    rng = random.Random(4)
    texts = list({"".join(rng.choice("ab") for _ in range(rng.randint(1, 24))) for _ in range(120)})
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {frozenset((r.a_id, r.b_id)) for r in fz.candidate_pairs(frame).collect()}
    for i, a in enumerate(texts):
        for j in range(i):
            if max(SequenceMatcher(None, a, texts[j]).ratio(), SequenceMatcher(None, texts[j], a).ratio()) >= 0.9:
                assert frozenset((i, j)) in found


def test_probe_rows_grow_with_the_length(spark):
    """Rows of the joined index are in proportion to the text."""
    for size in (50, 200):
        text = "".join(chr(97 + (i * i) % 26) for i in range(size))
        frame = spark.createDataFrame([(0, text), (1, text + "x")], "id int, text string")
        plan = fz.candidate_pairs(frame)
        assert [tuple(r) for r in plan.collect()] == [(0, 1)]
        longest = int(size * 1.1 / 0.9)
        assert 2 * int(0.1 * (size + longest)) + 1 <= 0.46 * size + 2


def sequential(pairs):
    """The greedy verdict in order of ids."""
    earlier, canonical = {}, {}
    for a, b in pairs:
        earlier.setdefault(b, []).append(a)
    for i in sorted({x for p in pairs for x in p}):
        canonical[i] = not any(canonical[a] for a in earlier.get(i, []))
    return {i: canonical[i] for i in earlier}


@pytest.mark.parametrize("kind", ["chain", "random", "comb"])
def test_followers_equal_the_sequence(spark, kind):
    rng = random.Random(6)
    pairs = {
        "chain": [(i, i + 1) for i in range(200)],
        "random": [tuple(sorted(rng.sample(range(80), 2))) for _ in range(160)],
        "comb": [(i, i + 1) for i in range(60)] + [(i, 100 + i) for i in range(60)] + [(rng.randrange(60), 100 + i) for i in range(60)],
    }[kind]
    pairs = sorted(set(pairs))
    frame = spark.createDataFrame(pairs, "earlier long, later long")
    assert {r.id: r.canonical for r in fz.followers(frame).collect()} == sequential(pairs)
