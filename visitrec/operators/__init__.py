"""DataFrame-to-DataFrame operators."""

from visitrec.operators.columns import (
    blanks_to_null,
    checkbox_columns,
    collapse_checkboxes,
    drop_required,
    form_columns,
    integers_by_suffix,
    keys_first,
    rename_headers,
    require_columns,
)
from visitrec.operators.gates import all_of, any_complete, any_of
from visitrec.operators.membership import (
    discrepancy,
    in_both,
    join_listed,
    no_keys,
    only_in,
    reconcile,
    requested_only,
    status_counts,
)
from visitrec.operators.ranking import id_list, in_order, key_batches, newest
from visitrec.operators.sieve import sieve, sieve_blocks

__all__ = [
    "all_of",
    "any_complete",
    "any_of",
    "blanks_to_null",
    "checkbox_columns",
    "collapse_checkboxes",
    "discrepancy",
    "drop_required",
    "form_columns",
    "id_list",
    "in_both",
    "in_order",
    "integers_by_suffix",
    "join_listed",
    "key_batches",
    "keys_first",
    "newest",
    "no_keys",
    "only_in",
    "reconcile",
    "rename_headers",
    "requested_only",
    "require_columns",
    "sieve",
    "sieve_blocks",
    "status_counts",
]
