from cohortforge.operators.contracts import Field, accepted, enforced, judged, rejected
from cohortforge.operators.events import (
    among,
    among_dealt,
    exclude,
    first_event,
    label_cohort,
    latest_records,
    rule_counts,
    rule_events,
)
from cohortforge.operators.keys import dense_key
from cohortforge.operators.ledger import count_groups, count_stage, count_steps, ledger
from cohortforge.operators.lookup import code_map, decode
from cohortforge.operators.merge import flag_exists, merge_flags, table_changes, upsert
from cohortforge.operators.peoplesets import count_common, count_sets, labelled_sets, people_sets
from cohortforge.operators.privacy import check_private, deidentify
from cohortforge.operators.profile import mask_small, panel_stats, profile, suppress
from cohortforge.operators.review import apply_selection, review_list, tagged_union

__all__ = [
    "Field",
    "accepted",
    "among",
    "among_dealt",
    "apply_selection",
    "check_private",
    "code_map",
    "count_common",
    "count_groups",
    "count_sets",
    "count_stage",
    "count_steps",
    "decode",
    "deidentify",
    "dense_key",
    "enforced",
    "exclude",
    "first_event",
    "flag_exists",
    "judged",
    "label_cohort",
    "labelled_sets",
    "latest_records",
    "ledger",
    "mask_small",
    "merge_flags",
    "panel_stats",
    "people_sets",
    "profile",
    "rejected",
    "review_list",
    "rule_counts",
    "rule_events",
    "suppress",
    "table_changes",
    "tagged_union",
    "upsert",
]
