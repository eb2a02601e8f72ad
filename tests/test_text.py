import random
import unicodedata

from pyspark.sql import functions as F

from conftest import one_column, results
from talweg.functions import keys as k
from talweg.functions import text as t
from talweg.functions.dates import date_folder, parse_date

V = F.col("v")


def expected_key(value):
    if value is None:
        return ""
    folded = "".join(c for c in unicodedata.normalize("NFKD", value.strip()) if ord(c) < 128)
    return " ".join(folded.split()).upper()


def test_rule_key_equals_nfkd_for_any_text(spark):
    rng = random.Random(7)
    pools = ["abc Áé\t", "ﬁ½㎏Ⅷ⑳…ŉĲ", "日本語Жя", "  \x1c\x85", "ﬀßøłÅ", "𝔄𝟙🅰"]
    values = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    values += [chr(c) + "x" for c in range(0x80, 0x3000, 7)] + [None, ""]
    got = results(one_column(spark, values), t.rule_key(V))
    assert [g for g in got] == [expected_key(v) for v in values]


def test_collapse_uses_python_white_space(spark):
    values = ["  Lavrado   com   espaco  ", "a b\x1cc d", "\x85x\x85", "", None]
    got = results(one_column(spark, values), t.collapse(V))
    assert got == [None if v is None else " ".join(v.split()) for v in values]


def test_mojibake_is_found_and_repaired(spark):
    twice = "ação".encode().decode("latin-1").encode().decode("latin-1")
    values = ["ESTAÃ\u0087Ã\u0083O ECOLÃ\u0093GICA", "ESTAÇÃO ECOLÓGICA CUNIÃ", "naÃ§Ã£o", twice,
              "â€œaspasâ€\u009d", "Ã\u0087 日", "plain", None]
    frame = one_column(spark, values)
    assert results(frame, t.looks_like_mojibake(V)) == [True, False, True, True, True, True, False, False]
    repaired = results(frame, t.repair_mojibake(V))
    assert repaired[:4] == ["ESTAÇÃO ECOLÓGICA", None, "nação", "ação"]
    assert repaired[5:] == [None, None, None]


def test_cp1252_round(spark):
    broken = "“ok”—€".encode("utf-8")
    text = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in broken)
    readable = "café – bar".encode().decode("cp1252")
    got = results(one_column(spark, [readable, text]), t.repair_mojibake(V))
    assert got[0] == "café – bar"


def test_title_and_domain_text(spark):
    values = ["AÃ§Ã£o", "CUNIÃ", "sem"]
    assert results(one_column(spark, values), t.repair_title(V)) == ["Ação", "CUNIÃ", "sem"]
    texts = ["Ilheus ¿ Itabuna", "A ? B", " x   y ", None]
    assert results(one_column(spark, texts), t.canonical_domain_text(V)) == ["Ilheus - Itabuna", "A - B", "x y", ""]


def test_alias_stem(spark):
    values = ["APP_RIOS", "Área de Preservação Permanente de Rios", "GAS", "Cidade dos Lagos", "A RECOMPOR"]
    assert results(one_column(spark, values), t.alias_stem(V)) == ["RIOS", "RIOS", "GAS", "CI LAGO", ""]


def test_condition_labels(spark):
    values = ["Analisado sem pendencias", "Aguardando análise", "Canselado", "Em analise", "  ", None, "???"]
    got = results(one_column(spark, values), t.condition_label(V))
    assert got == ["Analisado", "Aguardando analise", "Cancelado", "Em analise", "", None, "???"]


def test_dates(spark):
    values = ["2026-02-01 00:00:00", "31/01/2025", "2025-01-31", "01/31/2025", "nan", "", "31-12-2024", "x", None]
    got = [d.isoformat() if d else None for d in results(one_column(spark, values), parse_date(V))]
    assert got == ["2026-02-01", "2025-01-31", "2025-01-31", "2025-01-31", None, None, "2024-12-31", None, None]
    folders = results(one_column(spark, ["20210915", "2021-09-15", "05/06/2020", "31/12/2020", "?"]), date_folder(V))
    assert folders == ["20210915", "20210915", "20200506", "20201231", None]


def test_status(spark):
    values = ["download-treatment-publish", "schedule 2026-05-13 18:49", "download-review",
              "treatment; SCHEDULE:2026-05-13T18:49:30", "schedule 2026-99-13 18:49", None]
    plan = k.parse_status(V)
    got = results(one_column(spark, values), plan["flags"], plan["invalid"], plan["scheduled_for"].cast("string"))
    assert got[0] == (["download", "publish", "treatment"], [], None)
    assert got[1] == (["schedule"], [], "2026-05-13 18:49:00")
    assert got[2][1] == ["review"]
    assert got[3] == (["schedule", "treatment"], [], "2026-05-13 18:49:30")
    assert got[4][2] is None and got[4][1]
    assert got[5] == ([], [], None)


def test_versions_and_profile_keys(spark):
    assert results(one_column(spark, ["", "1.0", "007", "120", "v1"]), k.version_folder(V)) == ["00", "01", "07", "120", None]
    assert results(one_column(spark, [" RL  Car__am ", "a\\ B c/ /d_"]), t.profile_key(V)) == ["rl_car_am", "a/b_c/d"]
    states = ("ac", "ma")
    got = results(one_column(spark, ["app_car_ac", "x/RL_CAR_ma.gpkg", "sa_car_ac", "rl_car_zz"]), t.state_code(V, known=states))
    assert got == ["ac", "ma", None, None]
