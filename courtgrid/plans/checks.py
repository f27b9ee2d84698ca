"""The declared schema checks of the models (D1–D3): 9 unique, 29 not_null
and 6 relationships, as data for :func:`operators.quality.run_checks`."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import quality as Q

# model -> (unique, not null, relationships to a parent's client_code)
MODEL_CHECKS: dict[str, tuple[list[str], list[str], list[tuple[str, str, str]]]] = {
    "dim_clients": (["client_code"], ["client_code", "reservation_system_code"], []),
    "fct_reservations": (["reservation_pk"], ["reservation_pk", "client_code"],
                         [("client_code", "dim_clients", "client_code")]),
    "dim_members": (["member_pk"], ["member_pk", "client_code", "external_member_id", "reservation_system_code"],
                    [("client_code", "dim_clients", "client_code")]),
    "fct_events": (["event_pk"], ["event_pk", "client_code", "source_system", "event_id", "event_start_time"],
                   [("client_code", "dim_clients", "client_code")]),
    "fct_court_availability": (["availability_pk"], ["availability_pk", "client_code", "source_system", "court_id",
                                                     "court_name", "slot_start", "slot_end"],
                               [("client_code", "dim_clients", "client_code")]),
    "stg_reservations_a": (["reservation_pk"], ["reservation_pk", "client_code"], []),
    "stg_reservations_b": (["reservation_pk"], ["reservation_pk", "client_code"], []),
    "stg_reservations": (["reservation_pk"], ["reservation_pk", "client_code"],
                         [("client_code", "stg_organizations", "client_code")]),
    "stg_members": (["member_pk"], ["member_pk", "client_code", "external_member_id"],
                    [("client_code", "stg_organizations", "client_code")]),
}


def model_checks(models: dict[str, DataFrame]) -> DataFrame:
    """The declared checks of the models given; the parents of their
    relationships must be among them."""
    specs = [Q.TableChecks(name, models[name], *MODEL_CHECKS[name]) for name in MODEL_CHECKS if name in models]
    parents = {p for s in specs for _, p, _ in s.relationships} - {s.name for s in specs}
    return Q.run_checks(specs + [Q.TableChecks(p, models[p]) for p in sorted(parents)])
