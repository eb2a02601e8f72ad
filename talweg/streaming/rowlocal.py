"""Row-local treatment of a streaming feature table.

Cleaning, reprojection, metrics and column functions need no other row, so the
batch operators run unchanged on a stream; derived columns are always emitted,
because whether any value changed is never known for an unbounded table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from talweg.functions.naming import AREA, PERIMETER
from talweg.operators import schema as sc
from talweg.plans.registry import RuleContext, apply_column_functions
from talweg.plans.treatment import Profile, mandatory_treatments
from talweg.sources.rules import RuleTables


def treat_stream(df: DataFrame, rules: RuleTables, profile_name: str, measure: bool = True) -> DataFrame:
    profile = Profile.of(rules, profile_name)
    ctx = RuleContext(rules.of(profile_name), profile.config, theme=profile.theme)
    treated = mandatory_treatments(sc.normalize_columns(df))
    treated = apply_column_functions(treated, profile.functions, ctx)
    hidden = [c for c in treated.columns if c.startswith("__")]
    absent = () if measure else (AREA, PERIMETER)
    return sc.backfill_derived(treated.drop(*hidden, *absent))
