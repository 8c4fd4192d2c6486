"""Survey-like tables derived row by row from the given tables.

Codes come from key arithmetic, so every value grows with the data and SQL can derive the same table.
Expressions are common to Spark SQL and DuckDB.
"""

from __future__ import annotations


def code(key: str, n: int, base: int = 0) -> str:
    return f"CAST({base} + ({key}) % {n} AS INT)"


def holed(key: str, n: int, every: int, base: int = 0) -> str:
    """A code that is null on every ``every``-th key."""
    return f"CASE WHEN ({key}) % {every} = 0 THEN NULL ELSE {code(key, n, base)} END"


_P, _S, _L, _O = "l_partkey", "l_suppkey", "l_linenumber", "l_orderkey"
_HOME = f"CASE WHEN {_O} % 97 = 0 THEN NULL ELSE CAST({_O} AS STRING) END"
_PERSON = f"concat_ws('-', CAST({_O} AS STRING), CAST({_L} AS STRING))"

PERSON = {
    "fecha_creacion": f"CAST(2014 + {_O} % 2 AS STRING)",
    "data_date": f"concat(CAST(2014 + {_O} % 2 AS STRING), '-a')",
    "folioviv": _O,
    "hogar_id": _HOME,
    "person_id": _PERSON,
    "parentesco": code(_L, 6, 1),
    "edad": holed(f"{_P} * 7 + {_L} * 13", 95, 31),
    "sexo": code(_S, 2, 1),
    "anio": f"CAST(2014 + {_O} % 2 AS INT)",
    "asiste_escuela": holed(f"{_P} + {_L}", 2, 13),
    "aprobo_ultnivel": holed(f"{_P}", 10, 17),
    "aprobo_ultgrado": holed(f"{_S}", 7, 19),
    "antec_esc": code(f"{_P} + {_S}", 3, 1),
    "trabajo": holed(f"{_P} + 2 * {_L}", 2, 11),
    "trabaja_subord": holed(f"{_S} + {_L}", 2, 7),
    "trabaja_indep": holed(f"{_P} + {_S}", 2, 23),
    "con_sueldo": holed(f"{_P} * 3 + {_S}", 2, 29),
    "tipo_pago": holed(f"{_S} * 5 + {_P}", 4, 9),
    "id_trabajo": code(f"{_L} + {_S}", 2, 1),
    "act_pnea1": holed(f"{_P} + 3 * {_S}", 7, 3, 1),
    "act_pnea2": holed(f"2 * {_P} + {_S}", 7, 2, 1),
    "realiza_act_lab": holed(f"{_P} + {_L} * 2", 7, 8, 1),
    "realiza_act_nolab": holed(f"{_S} + {_L} * 3", 7, 6, 1),
    "c_instsal_a": f"CASE WHEN {_P} % 5 = 0 THEN 99 WHEN {_P} % 5 = 1 THEN NULL ELSE CAST({_P} % 5 AS INT) END",
    "c_instsal_b": holed(f"{_S}", 6, 4),
    "c_afilsal_a": holed(f"{_P} + {_S} * 2", 9, 5),
    "c_afilsal_b": holed(f"{_P} + {_L}", 9, 4),
    "c_salud_hoga": holed(f"{_O}", 9, 6),
    "c_salud_hogb": holed(f"{_O} + 1", 9, 5),
    "segvol_afore": code(f"{_P} + {_L}", 2),
    "segvol_medico": code(f"({_P} + {_S}) % 17", 2),
    "prestacion_incapacidad": holed(f"{_P} * 2 + {_S}", 2, 15),
    "prestacion_afore": holed(f"{_P} + {_S} * 3", 2, 14),
    "am_a": holed(f"{_P} + {_L}", 9, 10),
    "am_b": holed(f"{_S} + {_L}", 11, 9),
    "am_c": holed(f"{_P} * {_L}", 8, 7),
    "jubilado": holed(f"{_P} + 5 * {_L}", 2, 6),
    "clave": f"concat('P0', CAST(30 + {_P} % 20 AS STRING))",
    **{f"ing_{i}": f"CAST(l_quantity * {i} AS DOUBLE)" for i in range(1, 7)},
    "seguro_popular": code(f"{_P} + {_S}", 2),
    "am_imss": holed(f"{_P}", 2, 5),
    "am_issste": holed(f"{_S}", 2, 7),
    "am_issste_estatal": "0",
    "am_pemex": code(f"({_P} + {_L}) % 13", 2),
    "inscrito_contratacion": holed(f"{_P} + {_S}", 2, 9),
    "atencion_medica": holed(f"{_P} * 3 + {_L}", 2, 12),
    "am_imss_prospera": code(f"{_P} % 7 + {_S}", 2),
    "am_otra": holed(f"{_S} % 5", 7, 3),
    "inscrito_prestacion_lab": holed(f"{_P} + {_L} * 5", 2, 8),
    "inscrito_jubilacion": holed(f"{_S} % 7 + {_L}", 2, 4),
    "inscrito_familiar": holed(f"{_P} % 11", 2, 3),
    "inscrito_muerte_aseg": code(f"({_P} % 29) * {_L}", 2),
    "inscrito_estudiante": holed(f"{_S} % 13", 2, 5),
    "inscrito_familiar_otro": holed(f"{_P} % 19 + {_S}", 2, 6),
    "total_personas": code(_O, 9, 1),
    "total_cuartosdor": code(f"{_O} + 1", 5),
    "lengua_indigena": holed(_P, 3, 10),
    "habla_espanol": code(_S, 2),
    "remesas": "l_extendedprice - 30000",
    **{f"disc{i}": holed(f"{_P} + {i} * {_S}", 9, 2) for i in range(1, 8)},
    "factor": "l_quantity",
}

_K, _C = "o_orderkey", "o_custkey"
HOME = {
    "fecha_creacion": f"CAST(2014 + {_K} % 2 AS STRING)",
    "data_date": f"concat(CAST(2014 + {_K} % 2 AS STRING), '-a')",
    "folioviv": _K,
    "hogar_id": f"CAST({_K} AS STRING)",
    "edad": holed(f"{_C} * 7", 90, 31),
    "servicio_agua": holed(_C, 7, 12, 1),
    "servicio_drenaje": holed(f"{_C} + {_K}", 6, 13, 1),
    "servicio_elect": holed(f"{_K}", 3, 14, 1),
    "fuente_combustible": code(f"{_C} * 3", 4, 1),
    "estufa_sinchimenea": holed(f"{_C} + 1", 2, 15),
    "total_personas": code(_K, 9, 1),
    "total_cuartosdor": code(f"{_C} + 2", 5),
    "material_pisos": code(_C, 3, 1),
    "material_muros": holed(_K, 9, 16, 1),
    "material_techos": code(f"{_K} + {_C}", 10, 1),
    "elimina_basura": code(_K, 8, 1),
    "tipo_escusado": code(_C, 6, 1),
    "c_salud_hoga": holed(_K, 9, 6),
    "c_salud_hogb": holed(f"{_K} + 1", 9, 5),
    "ubica_geo": f"lpad(CAST({_K} AS STRING), greatest(9, CAST(length(CAST({_K} AS STRING)) AS INTEGER)), '0')",
    "ing_cor": "o_totalprice",
    "remesas": "o_totalprice - 100000",
    "escusado_exclusivo": code(f"{_K} + 1", 2),
    "tenencia": code(f"{_C} + {_K}", 7, 1),
    **{
        name: (holed(f"{_C} * {i} + {_K}", 2, 25) if i == 3 else code(f"{_C} * {i} + {_K}", 2))
        for i, name in enumerate(
            [
                "alim_pocavar", "alim_dejocomida", "alim_comiomenos", "alim_sincomida", "alim_nocomio", "alim_comiouna",
                "alim_menor_pocavar", "alim_menor_comiomenos", "alim_menor_disminuyo", "alim_menor_nocomio",
                "alim_menor_acosto", "alim_menor_comiouna",
            ],
            start=1,
        )
    },
    **{n: code(f"{_C} + {i} * {_K}", 3) for i, n in enumerate(["num_refri", "num_auto", "num_van", "num_pickup", "num_video", "num_compu", "num_micro", "num_lavad", "num_estuf"], start=1)},
    "telefono": code(f"{_C} % 7 + {_K}", 2),
    "ent": f"lpad(CAST({_C} % 32 + 1 AS STRING), greatest(2, CAST(length(CAST({_C} % 32 + 1 AS STRING)) AS INTEGER)), '0')",
    "factor": f"CAST(1 + {_C} % 40 AS DOUBLE)",
    "rururb": code(_K, 2),
    "ictpc": f"CASE WHEN {_K} % 41 = 0 THEN NULL ELSE o_totalprice / 100 END",
    "plb": f"CASE WHEN {_K} % 41 = 0 THEN NULL WHEN o_totalprice / 100 < 2000 THEN 1 ELSE 0 END",
    "plb_m": f"CASE WHEN {_K} % 41 = 0 THEN NULL WHEN o_totalprice / 100 < 1000 THEN 1 ELSE 0 END",
    "ic_rezedu": holed(_C, 2, 37),
    "ic_asalud": code(f"{_C} + {_K} % 5", 2),
    "ic_segsoc": code(f"{_K} % 3 + {_C}", 2),
    "ic_cv": code(f"{_K} % 7", 2),
    "ic_sbv": code(f"{_C} % 5", 2),
    "ic_ali": code(f"{_C} % 11 + {_K}", 2),
}

# incidents: one per event, placed by user
CRIME = {
    "anio": "CAST(2024 AS INT)",
    "mes": "CASE WHEN user_id % 3 = 0 THEN 'Abril' WHEN user_id % 3 = 1 THEN 'Enero' ELSE 'Agosto' END",
    "cve_muni": "lpad(CAST(user_id AS STRING), greatest(5, CAST(length(CAST(user_id AS STRING)) AS INTEGER)), '0')",
    "subtipodedelito": "event_type",
    "incidencia_delictiva": "value",
}

# census persons
CENSUS = {
    "ent": code(_S, 32, 1),
    "mun": code(_P, 20, 1),
    "nom_mun": f"CAST({_P} % 20 AS STRING)",
    "nom_mun_res10": f"CAST(({_P} + {_L} % 2) % 20 AS STRING)",
    "ent_pais_res10": code(f"{_P} + {_S}", 40),
    "factor": "CAST(l_quantity AS INT)",
    "sexo": f"CASE WHEN {_L} % 2 = 0 THEN 1 ELSE 3 END",
    "edad": holed(f"{_P} * 7 + {_L} * 13", 95, 31),
    "perte_indigena": code(_L, 4, 1),
    "hlengua": code(_P, 3, 1),
    "afrodes": code(_S, 4, 1),
    "conact": code(f"{_P} + {_L}", 30, 1),
    **{f"acti_sin_pago{i}": holed(f"{_P} + {i} * {_L}", 20, 101) for i in range(1, 9)},
    "mun_asi": f"CASE WHEN {_P} % 6 = 0 THEN NULL ELSE {code(_P + ' + ' + _L, 20, 1)} END",
    "ent_pais_asi": code(_S, 32, 1),
    "mun_trab": code(f"{_P} + {_L} * 3", 20, 1),
    "ent_pais_trab": f"CASE WHEN {_S} % 9 = 0 THEN NULL ELSE {code(_S, 32, 1)} END",
}

# raw beneficiary lines: a pipe-delimited text per order line
RAW_BENEFICIARY = {
    "value": "concat_ws('|', "
    + ", ".join(
        [
            f"concat('dep', CAST({_S} % 3 AS STRING))",
            f"CASE WHEN {_P} % 4 = 0 THEN 'FEDERAL' WHEN {_P} % 4 = 1 THEN 'ESTATAL' WHEN {_P} % 4 = 2 THEN 'MUNI' ELSE 'x' END",
            f"CAST({_P} AS STRING)",
            f"concat('S', lpad(CAST({_S} % 3 AS STRING), greatest(3, CAST(length(CAST({_S} % 3 AS STRING)) AS INTEGER)), '0'))",
            f"concat('P', CAST({_P} % 2 AS STRING))",
            f"CAST(2013 + {_O} % 3 AS STRING)",
            f"concat('13', CASE WHEN {_L} = 1 THEN 'a' WHEN {_L} = 2 THEN 'B' WHEN {_L} = 3 THEN 'c' WHEN {_L} = 4 THEN 'x' ELSE CAST({_L} AS STRING) END)",
            "'Perez'",
            "'Lopez'",
            f"concat('Ana', CAST({_P} % 3 AS STRING))",
            f"CASE WHEN {_P} % 50 = 0 THEN '19900231' ELSE concat(CAST(1930 + {_P} % 85 AS STRING), lpad(CAST(1 + {_S} % 12 AS STRING), greatest(2, CAST(length(CAST(1 + {_S} % 12 AS STRING)) AS INTEGER)), '0'), lpad(CAST(1 + {_L} * 3 AS STRING), 2, '0')) END",
            f"CASE WHEN {_S} % 3 = 0 THEN 'H' WHEN {_S} % 3 = 1 THEN '\"M\"' ELSE '' END",
            f"CAST({_P} % 14 AS STRING)",
            f"concat('N', CAST({_O} AS STRING))",
            f"CASE WHEN {_P} % 20 = 0 THEN '' ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END",
            f"CAST({_S} % 6 * 7 AS STRING)",
            f"CASE WHEN {_P} % 30 = 0 THEN '999' ELSE CAST({_P} % 13 AS STRING) END",
            f"CAST({_P} % 10001 AS STRING)",
            "'1'",
            f"CAST({_L} AS STRING)",
        ]
    )
    + ")"
}

SHAPES: dict[str, tuple[str, dict[str, str]]] = {
    "person": ("lineitem", PERSON),
    "home": ("orders", HOME),
    "crime": ("events", CRIME),
    "census": ("lineitem", CENSUS),
    "raw_beneficiary": ("lineitem", RAW_BENEFICIARY),
    # pseudo-coordinates
    "supplier_place": (
        "supplier",
        {
            "s_suppkey": "s_suppkey",
            "lat": "CAST(14 + (s_suppkey * 37) % 180 / 10.0e0 AS DOUBLE)",
            "lon": "CAST(-117 + (s_suppkey * 53) % 300 / 10.0e0 AS DOUBLE)",
            "value": "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END",
            "s_nationkey": "s_nationkey",
        },
    ),
    "customer_place": (
        "customer",
        {
            "c_custkey": "c_custkey",
            "lat": "CAST(14 + (c_custkey * 29) % 185 / 10.0e0 AS DOUBLE)",
            "lon": "CAST(-117 + (c_custkey * 41) % 310 / 10.0e0 AS DOUBLE)",
            "c_acctbal": "c_acctbal",
            "c_nationkey": "c_nationkey",
        },
    ),
}
