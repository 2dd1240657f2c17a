"""Run parameters of the cohort pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------
# These must equal the clinical pipeline's constants for equal results.
# Lab labels kept for the abnormal-lab history (matched exactly, case-sensitive):
CLINICAL_LAB_LABELS = (
    "Creatinine", "eGFR", "BUN", "Sodium", "Potassium", "Chloride",
    "Bicarbonate", "Calcium", "Phosphate", "Albumin", "Hemoglobin", "Platelets",
)
# Category code of the prediction target (chronic kidney disease):
CLINICAL_TARGET_CODE = "GEN003"
# Lab flags that mean "abnormal", compared after upper-casing:
ABNORMAL_FLAGS = ("ABNORMAL", "HIGH", "LOW", "CRITICAL")
# Category given to a diagnosis whose code version is neither 9 nor 10:
INVALID_CODE = "Invalid"
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class CohortConfig:
    relevant_labs: tuple[str, ...] = CLINICAL_LAB_LABELS
    target_code: str = CLINICAL_TARGET_CODE
    abnormal_flags: tuple[str, ...] = ABNORMAL_FLAGS
    seed: int = 42
    # group split: share of entities in train, then in train+val (70/15/15)
    train_pct: int = 70
    train_val_pct: int = 85
    k_folds: int = 3
    # titles joined on the code alone (as the reference does) or on (code, version)
    title_join_on_version: bool = False
    extra: dict = field(default_factory=dict)


# Role set for the driver's star-schema tables (see FIXTURES.md): part types stand in for
# lab labels and one brand for the target category.
FIXTURE_CONFIG = CohortConfig(relevant_labs=("PROMO", "SMALL", "LARGE"), target_code="Brand#13")
