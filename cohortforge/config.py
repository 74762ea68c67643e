"""Study parameters: everything a site changes without touching a stage."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Rule:
    """One positive-result rule: results of `step` count when `kind` holds.

    kind: "flag" (qualitative flag is 1), "above" (harmonised number over
    `value`, sentinel excluded) or "text" (trimmed result equals `value`).
    """

    step: str
    kind: str
    value: object = None


# The case-finding rules of the laboratory algorithm.
POSITIVE_RULES = (
    Rule("2", "flag"),
    Rule("1A", "above", 200),
    Rule("1B", "above", 20),
    Rule("1C", "text", "DETECTED"),
    Rule("1D", "flag"),
    Rule("1", "flag"),
)

# Height, weight, blood pressure, pulse, temperature,
# respiratory rate, body mass index, pulse oximetry.
VITAL_MEASURES = ("11", "14", "5", "8", "6", "9", "301070", "10")

# Visit type code -> label.
VISIT_TYPES = {
    "ED": "Emergency Department only",
    "EI": "Emergency to Inpatient",
    "ES": "Still in ED",
    "IP": "Inpatient",
    "AV": "Ambulatory Visit",
    "OT": "Other",
    "UN": "Unknown",
    "OA": "Other Ambulatory Visit",
    "NI": "No Information",
    "IS": "Non-Acute Institutional Stay",
    "EO": "Observation",
    "IO": "Observation",
}


@dataclass(frozen=True)
class StudyConfig:
    window_start: date
    window_end: date
    as_of: date
    salt: str
    dx_flag: str = "TARGET"
    adult_age: int = 18
    rules: tuple[Rule, ...] = POSITIVE_RULES
    numeric_sentinel: int = 9999999
    strict_decimals: bool = False
    cohort_lab_types: tuple[int, ...] = (7,)
    lab_types: tuple[int, ...] = (7, 26, 62, 63)
    restricted_flags: tuple[int, ...] = (6, 8, 9, 1018, 1053)
    placeholder_medication: int = 800001
    excluded_code_prefix: str = "IMO0"
    icd_cutover: date = date(2015, 1, 1)
    vital_measures: tuple[str, ...] = VITAL_MEASURES
    care_provider_type: str = "PHYSICIAN"
    completed_status: int = 5
    imaging_types: tuple[int, ...] = (5, 1003)
    microbiology_type: int = 3
    pathology_type: int = 59
    final_radiology: int = 99
    mask_floor: int = 10

    def __post_init__(self) -> None:
        if not self.salt:
            raise ValueError("a salt is required: without one, study ids can be recomputed")
