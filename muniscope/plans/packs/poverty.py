"""Multidimensional poverty from six deprivations and two income lines."""

from __future__ import annotations

from ...operators.rules import Rule

# The six deprivation flags.
FLAGS = ["ic_rezedu", "ic_asalud", "ic_segsoc", "ic_cv", "ic_sbv", "ic_ali"]
# Monthly lines of 2014, minimum and full, urban and rural.
LINES = {"min_urban": 1242.61, "min_rural": 868.25, "full_urban": 2542.24, "full_rural": 1614.64}


def _two_way(name: str, one: str, zero: str) -> Rule:
    """1, 0, or null where poverty itself is unknown."""
    return Rule.cases(name, ("pobreza IS NULL", "NULL"), (one, 1), (zero, 0))


def _gap(name: str, below: str, urban: float, rural: float) -> Rule:
    """Distance to the line as a share of it for people below it, 0 for the others with known income."""
    return Rule.cases(
        name,
        (f"rururb = 1 AND {below} = 1", f"(CAST({rural} AS DOUBLE) - ictpc) / CAST({rural} AS DOUBLE)"),
        (f"rururb = 0 AND {below} = 1", f"(CAST({urban} AS DOUBLE) - ictpc) / CAST({urban} AS DOUBLE)"),
        ("ictpc IS NOT NULL", "CAST(0 AS DOUBLE)"),
    )


def poverty_rules(lines: dict[str, float] = LINES) -> list[Rule]:
    both = "i_privacion IS NOT NULL AND plb IS NOT NULL"
    both_min = "i_privacion IS NOT NULL AND plb_m IS NOT NULL"
    return [
        Rule("i_privacion", " + ".join(FLAGS)),
        Rule.cases("pobreza", ("i_privacion >= 1 AND plb = 1", 1), (f"(plb = 0 OR i_privacion = 0) AND {both}", 0)),
        Rule.cases("pobreza_e", ("i_privacion >= 3 AND plb_m = 1", 1), (f"(plb_m = 0 OR i_privacion < 3) AND {both_min}", 0)),
        Rule.cases("pobreza_m", ("pobreza = 1 AND pobreza_e = 0", 1), ("pobreza = 0 OR (pobreza = 1 AND pobreza_e = 1)", 0)),
        _two_way("vul_car", "i_privacion >= 1 AND plb = 0", "plb = 1 OR (plb = 0 AND i_privacion = 0)"),
        _two_way("vul_ing", "i_privacion = 0 AND plb = 1", "plb = 0 OR (plb = 1 AND i_privacion >= 1)"),
        _two_way("no_pobv", "i_privacion = 0 AND plb = 0", "plb = 1 OR (plb = 0 AND i_privacion >= 1)"),
        _two_way("carencias", "i_privacion >= 1", "i_privacion = 0"),
        _two_way("carencias3", "i_privacion >= 3", "i_privacion <= 2"),
        Rule.cases(
            "cuadrantes",
            ("i_privacion >= 1 AND plb = 1", 1),
            ("i_privacion >= 1 AND plb = 0", 2),
            ("i_privacion = 0 AND plb = 1", 3),
            ("i_privacion = 0 AND plb = 0", 4),
        ),
        _gap("prof_b1", "plb", lines["full_urban"], lines["full_rural"]),
        _gap("prof_bm1", "plb_m", lines["min_urban"], lines["min_rural"]),
        Rule("profun", "CAST(i_privacion AS DOUBLE) / 6"),
        Rule("int_pob", "profun * pobreza"),
        Rule("int_pobe", "profun * pobreza_e"),
        Rule("int_vulcar", "profun * vul_car"),
        Rule("int_caren", "profun * carencias"),
    ]
