"""The admissions tables as one configuration of the library: names, domains, contracts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardframe.functions.cleaning import known_count
from wardframe.operators.clean import Typing, mean_of_scaled, mean_of_two, product
from wardframe.operators.contracts import Contract, Rule, column, distinct_rows, holds
from wardframe.operators.prep import PrepPlan

# --- Fixed values: columns, domains and levels of the admissions tables -------------------
TARGET = "chance_of_admit"
PREDICTORS = ("gre_score", "toefl_score", "university_rating", "sop", "lor", "cgpa", "research")
COLUMNS = (*PREDICTORS, TARGET)
NUMERIC = ("gre_score", "toefl_score", "sop", "lor", "cgpa")
RATING_LEVELS = ("1", "2", "3", "4", "5")
RATING_CODES = (1.0, 2.0, 3.0, 4.0, 5.0)
# accepted range of each column
RANGES = {
    "gre_score": (0, 340), "toefl_score": (0, 120), "sop": (1, 5), "lor": (1, 5), "cgpa": (0, 10), TARGET: (0, 1),
}
# clipping domain of each predictor
DOMAINS = {
    "gre_score": (0, 340), "toefl_score": (0, 120), "university_rating": (1, 5), "sop": (1, 5), "lor": (1, 5),
    "cgpa": (0, 10), "research": (0, 1),
}
# scaling domain of the heuristic
HEURISTIC_DOMAINS = {
    "gre_score": (260, 340), "toefl_score": (0, 120), "university_rating": (1, 5), "sop": (1, 5), "lor": (1, 5),
    "cgpa": (0, 10), "research": (0, 1),
}
MIN_KNOWN_PREDICTORS = 4
DERIVED_TOLERANCE = 1e-9

TYPING = Typing(
    integers=("gre_score", "toefl_score"), decimals=("sop", "lor", "cgpa", TARGET), booleans=("research",),
    ordinals={"university_rating": RATING_LEVELS}, boolean_words={"0": False, "1": True},
)


def _known(columns: tuple[str, ...], least: int) -> Column:
    return known_count([F.col(c) for c in columns]) >= least


def _agrees(expected: Column, stored: str) -> Column:
    """Equal within the tolerance; a NULL on either side passes."""
    return F.coalesce(F.abs(expected - F.col(stored)) <= DERIVED_TOLERANCE, F.lit(True))


def derived_columns() -> dict[str, Column]:
    return {
        "indice_academico": mean_of_scaled({"cgpa": (0, 10), "gre_score": (260, 340), "toefl_score": (0, 120)}),
        "sop_lor_media": mean_of_two("sop", "lor"),
        "rating_x_research": product("university_rating", "research"),
    }


USABLE_RECORD = holds(
    "registro_utilizable", f"at least {MIN_KNOWN_PREDICTORS} of {len(PREDICTORS)} predictors are known", PREDICTORS,
    lambda: _known(PREDICTORS, MIN_KNOWN_PREDICTORS),
)
ACADEMIC_PROFILE = holds(
    "perfil_academico_minimo", "one of gre_score, toefl_score and cgpa is known", ("gre_score", "toefl_score", "cgpa"),
    lambda: _known(("gre_score", "toefl_score", "cgpa"), 1),
)
COHERENT = tuple(
    holds(f"{name}_coherente", f"{name} follows its formula", (*inputs, name), lambda name=name: _agrees(derived_columns()[name], name))
    for name, inputs in (
        ("sop_lor_media", ("sop", "lor")),
        ("rating_x_research", ("university_rating", "research")),
        ("indice_academico", ("cgpa", "gre_score", "toefl_score")),
    )
)


def _rules(number_type: dict[str, str], with_target: bool) -> list[Rule]:
    codes = {"university_rating": RATING_CODES, "research": (0.0, 1.0)}
    rules = [rule for c in PREDICTORS for rule in column(c, types=(number_type[c],), among=codes.get(c), within=None if c in codes else RANGES[c])]
    return rules + (column(TARGET, types=("double",), within=RANGES[TARGET], nulls=0.0) if with_target else [])


_TYPED = {
    "gre_score": "bigint", "toefl_score": "bigint", "university_rating": "string", "sop": "double", "lor": "double",
    "cgpa": "double", "research": "boolean",
}

SOURCE_CONTRACT = Contract(_rules(_TYPED, True), distinct_rows(), USABLE_RECORD, ACADEMIC_PROFILE)
ENTRY_CONTRACT = Contract(_rules(_TYPED, False), USABLE_RECORD)
FEATURE_CONTRACT = Contract(
    _rules(dict.fromkeys(PREDICTORS, "double"), True),
    column("indice_academico", types=("double",), optional=True),
    column("sop_lor_media", types=("double",), within=(1, 5), optional=True),
    column("rating_x_research", types=("double",), within=(0, 5), optional=True),
    distinct_rows(), USABLE_RECORD, ACADEMIC_PROFILE, *COHERENT,
)

PREP = PrepPlan(
    numeric=NUMERIC, ordinal={"university_rating": RATING_CODES}, boolean=("research",), domains=DOMAINS,
)

def _without(*columns: str) -> PrepPlan:
    return replace(PREP, numeric=tuple(c for c in PREP.numeric if c not in columns))


# The seven preparation variants that are compared with each other.
VARIANTS = {
    "1_base": PREP,
    "2_onehot": replace(PREP, onehot=True),
    "3_derivados": replace(PREP, derived={
        "indice_academico": "(cgpa/10 + (gre_score-260)/80 + toefl_score/120)/3",
        "sop_lor_media": "(sop+lor)/2", "rating_x_research": "double(university_rating)*double(research)",
    }),
    "4_no_lineales": replace(PREP, log=("cgpa",), root=("sop",), square=("gre_score",)),
    "5_sin_toefl": _without("toefl_score"),
    "6_minimo": _without("gre_score", "toefl_score", "sop"),
    "7_indicador": replace(PREP, indicator=True),
}

# In a batch the target, when present, is context: it keeps its original text.
TYPING_WITHOUT_TARGET = Typing(
    integers=TYPING.integers, decimals=("sop", "lor", "cgpa"), booleans=TYPING.booleans, ordinals=TYPING.ordinals,
    boolean_words=TYPING.boolean_words,
)
