"""The two text renderings of a patient row (built from ``concat``, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.exprs import comma_join_or_none, space_join, text_or_nan

# ---------------------------------------------------------------------------------------
# Literal text of the two renderings (must match for equal output).
# history form : "diagnoses:{dx} , {labs} age:{age} , gender:{gender} , number of visits:{n}"
# sentence form: "The patient is a {age} years old {male|female}. Diagnoses include {dx}.
#                 Abnormal lab tests include {labs}."
# gender text  : 'M' -> "male", anything else (null too) -> "female"
# empty list   : '' in the history form, "none" in the sentence form
# ---------------------------------------------------------------------------------------


def history_text(diagnoses="diagnoses", abnormal_labs="abnormal_labs", age="age",
                 gender="gender", num_visits="num_visits") -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat(
        F.lit("diagnoses:"), space_join(c(diagnoses)), F.lit(" , "),
        space_join(c(abnormal_labs)), F.lit(" age:"), text_or_nan(c(age)),
        F.lit(" , gender:"), text_or_nan(c(gender)),
        F.lit(" , number of visits:"), text_or_nan(c(num_visits)),
    )


def gender_word(gender="gender") -> Column:
    g = F.col(gender) if isinstance(gender, str) else gender
    return F.when(g == F.lit("M"), F.lit("male")).otherwise(F.lit("female"))


def clinical_sentence(age="age", gender="gender", diagnoses="diagnoses",
                      abnormal_labs="abnormal_labs") -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat(
        F.lit("The patient is a "), text_or_nan(c(age)), F.lit(" years old "), gender_word(c(gender)),
        F.lit(". Diagnoses include "), comma_join_or_none(c(diagnoses)),
        F.lit(". Abnormal lab tests include "), comma_join_or_none(c(abnormal_labs)), F.lit("."),
    )
