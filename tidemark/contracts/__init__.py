"""Data contracts: declared schemas and checks, evaluated in one aggregation over the data."""

from .checks import check_types, register
from .engine import ContractReport, ContractViolation, enforce, results_frame, summarize, validate, write_report
from .spec import CheckSpec, ColumnSpec, Contract, ContractError, contract_from as contract_from_dict, load_contract, load_contracts, parse_duration

__all__ = ["CheckSpec", "ColumnSpec", "Contract", "ContractError", "ContractReport", "ContractViolation", "check_types", "contract_from_dict", "enforce", "load_contract", "load_contracts", "parse_duration", "register", "results_frame", "summarize", "validate", "write_report"]
