"""Business configuration of the ledger.

Every value in ``LedgerConfig``'s defaults is a FIXED VALUE that must equal
the source queries for the results to match: document-type lists, status
codes, lookup-table coordinates, GL exclusion lists, labels and the
plant names. Callers with another chart of accounts pass their own config.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LedgerConfig:
    # --- FIXED VALUES (must equal the source queries) -----------------------
    # Document classes
    sales_types: tuple = ("AV", "S1", "S6", "S7", "SA", "SJ", "SM", "SO", "SX")
    export_type: str = "SX"
    return_types: tuple = ("VR", "VX")
    sales_excluded_next_status: tuple = ("996", "994")
    sales_min_last_status: str = "615"
    return_next_status: tuple = ("615", "610", "617", "620", "999")
    excluded_cfop: tuple = (1949,)
    item_line_codes: tuple = ("0", "1", "2", "3", "4", "L")
    tax_code_pis: str = "05"
    tax_code_cofins: str = "06"
    # Code-table coordinates (system code, record type)
    account_group_lookup: tuple = ("09", "09")      # -> CONTA
    account_subgroup_lookup: tuple = ("09", "10")   # -> CONTA_I
    rate_balloons_lookup: tuple = ("00", "49")      # -> allocation % text
    rate_multiuse_lookup: tuple = ("00", "50")      # -> allocation % text
    item_category_system: str = "41"
    item_category_types: tuple = ("S1", "S2", "S3", "S4", "S5")
    # GL ledger selection
    ledger_type: str = "AA"
    posted_flag: str = "P"
    # GL rows rebuilt by the document branches, hence excluded on the GL side
    gl_excluded_groups: tuple = ("Faturamento Bruto", "(-) IMPOSTOS FATURADO")
    gl_excluded_subgroups: tuple = ("Devoluções",)
    gl_excluded_structures: tuple = ("311210001", "311210004", "311210003")
    exclusion_sentinel: str = "§§"
    # Labels
    returns_subgroup_label: str = "Devolucoes"
    plant_item_line: str = "3"
    plant_label_special: str = "200 LATEX SAO ROQUE - FABRICA II"
    plant_label_default: str = "100 LATEX SAO ROQUE - 3 MAIO"
    allocation_labels: tuple = (" ", "BALOES", "LUVAS MULTIUSO")
    balance_doc_type: str = "SM"
    balance_doc_number: str = "SALDO_MENSAL"
    balance_explanation: str = "SALDO F0902"
    gl_query_info: int = 1
    # --- end of fixed values ------------------------------------------------

    # Engineering knobs (not part of the source semantics)
    # Largest side broadcast after a checked count (counted rows times the width
    # of a row, see operators.lookups.row_width). Larger sides use shuffle joins.
    broadcast_max_bytes: int = 64 << 20
    require_unique_lookups: bool = True    # code table: a duplicate key raises
    # Master tables (accounts, units, companies, items, natures): the source joins
    # them, so a duplicate key multiplies rows; True raises instead.
    require_unique_masters: bool = False
    # document_ledger writes its document lines once to spark.checkpoint.dir
    # (one fact scan for its three consumers, lineage cut for executor loss).
    materialize_documents: bool = True
    # Build the account and item dimensions once per table bundle (checkpoint).
    materialize_dimensions: bool = True

    def returns_label_old(self) -> "LedgerConfig":
        """The older query labels returns 'Devoluções' instead of 'Devolucoes'."""
        from dataclasses import replace
        return replace(self, returns_subgroup_label="Devoluções")


DEFAULT_CONFIG = LedgerConfig()
