"""Social deprivation rules at person and household grain."""

from __future__ import annotations

from ...operators.rules import Rule

HOME = ("fecha_creacion", "hogar_id")
PERSON = ("fecha_creacion", "person_id")


def yes(column: str, *codes: int) -> str:
    """Column holds one of the codes; a missing answer counts as no."""
    listed = ", ".join(str(c) for c in codes)
    return f"coalesce({column} IN ({listed}), FALSE)"


def either(columns: list[str], *codes: int) -> str:
    return " OR ".join(yes(c, *codes) for c in columns)


# --- schooling -----------------------------------------------------------------------------------
_UPPER = "aprobo_ultnivel IN (5, 6)"
REZAGO_EDUCATIVO = [
    Rule("antec_esc", "1"),
    Rule.cases(
        "nivel_edu",
        ("aprobo_ultnivel < 2 OR (aprobo_ultnivel = 2 AND aprobo_ultgrado < 6)", 0),
        (
            "(aprobo_ultnivel = 2 AND aprobo_ultgrado = 6) OR (aprobo_ultnivel = 3 AND aprobo_ultgrado < 3) "
            f"OR ({_UPPER} AND aprobo_ultgrado < 3 AND antec_esc = 1)",
            1,
        ),
        (
            "(aprobo_ultnivel = 3 AND aprobo_ultgrado = 3) OR aprobo_ultnivel = 4 OR aprobo_ultnivel >= 7 "
            f"OR ({_UPPER} AND antec_esc = 1 AND aprobo_ultgrado >= 3) OR ({_UPPER} AND antec_esc >= 2)",
            2,
        ),
    ),
    Rule("a_nacimiento", "anio - edad"),
    Rule.dummy(
        "ic_rezago_educativo",
        "(edad BETWEEN 3 AND 15 AND asiste_escuela = 0 AND nivel_edu IN (0, 1)) "
        "OR (edad >= 16 AND a_nacimiento >= 1982 AND nivel_edu IN (0, 1)) "
        "OR (edad >= 16 AND a_nacimiento <= 1981 AND nivel_edu = 0)",
    ),
]

# --- dwelling ------------------------------------------------------------------------------------
def services(water: str) -> list[Rule]:
    return [
        Rule.dummy("ic_servicio_agua", water),
        Rule.dummy("ic_servicio_drenaje", "servicio_drenaje <= 3"),
        Rule.dummy("ic_servicio_electricidad", "servicio_elect = 1"),
        Rule.dummy("ic_combustible", "fuente_combustible = 1 AND estufa_sinchimenea = 1"),
        Rule.dummy(
            "ic_servicios_basicos",
            "ic_servicio_agua = 1 OR ic_servicio_drenaje = 1 OR ic_servicio_electricidad = 1 OR ic_combustible = 1",
        ),
    ]


# As published any stated water service counts as deprived; the second form applies the limit of 3.
CARENCIA_SERVICIOS = services("servicio_agua <= 3 OR servicio_agua IS NOT NULL")
CARENCIA_SERVICIOS_LIMIT = services("servicio_agua <= 3")

CARENCIA_VIVIENDA = [
    Rule("indice_hacinamiento", "CAST(total_personas AS DOUBLE) / nullif(total_cuartosdor, 0)"),
    Rule.dummy("ic_hacinamiento", "indice_hacinamiento > 2.5"),
    Rule.dummy("ic_material_piso", "material_pisos = 1"),
    Rule.dummy("ic_material_muros", "material_muros <= 5"),
    Rule.dummy("ic_material_techos", "material_techos <= 2"),
    Rule.dummy(
        "ic_vivienda",
        "ic_hacinamiento = 1 OR ic_material_piso = 1 OR ic_material_techos = 1 OR ic_material_muros = 1",
    ),
]

# --- food ----------------------------------------------------------------------------------------
# The twelve yes/no items of the food scale.
FOOD_ITEMS = [
    "alim_pocavar", "alim_dejocomida", "alim_comiomenos", "alim_sincomida", "alim_nocomio", "alim_comiouna",
    "alim_menor_pocavar", "alim_menor_comiomenos", "alim_menor_disminuyo",
    "alim_menor_nocomio", "alim_menor_acosto", "alim_menor_comiouna",
]
CARENCIA_ALIMENTARIA = [
    Rule.grouped("min_edad", "min", "edad", HOME),
    Rule.dummy("i_menores18", "min_edad BETWEEN 0 AND 17"),
    Rule("total_ia", " + ".join(FOOD_ITEMS)),
    Rule.cases(
        "inseguridad_alimentaria",
        ("total_ia = 0", 0),
        ("total_ia IN (1, 2) OR (total_ia = 3 AND i_menores18 = 1)", 1),
        ("(i_menores18 = 0 AND total_ia IN (3, 4)) OR (i_menores18 = 1 AND total_ia BETWEEN 4 AND 7)", 2),
        ("(i_menores18 = 0 AND total_ia IN (5, 6)) OR total_ia >= 8", 3),
    ),
    Rule.dummy("ic_alimentacion", "inseguridad_alimentaria IN (2, 3)"),
]

# --- work ----------------------------------------------------------------------------------------
_ADULT = "coalesce(edad >= 16, FALSE)"
_PNEA = ["act_pnea1", "act_pnea2"]
TRABAJO_ENIGH = [
    Rule.cases(
        "pea",
        (f"trabajo = 1 AND {_ADULT} AND act_pnea1 IS NULL AND act_pnea2 IS NULL", 1),
        (f"{_ADULT} AND ({either(_PNEA, 1)})", 2),
        (f"{_ADULT} AND ({either(_PNEA, 2, 3, 4, 5, 6)})", 0),
    ),
    Rule.cases(
        "tipo_trab",
        (yes("trabaja_subord", 1), 1),
        (f"{yes('trabaja_subord', 0)} AND {yes('trabaja_indep', 1)} AND ({yes('con_sueldo', 1)} OR {yes('tipo_pago', 1)})", 2),
        (
            f"{yes('trabaja_subord', 0)} AND (({yes('trabaja_indep', 1)} AND {yes('con_sueldo', 0)}) "
            f"OR ({yes('trabaja_indep', 0)} AND {yes('tipo_pago', 2, 3)}))",
            3,
        ),
    ),
    Rule.dummy("jubilado", f"{yes('trabajo', 0)} AND ({either(_PNEA, 2)})"),
]
_ACTIVE = "coalesce(realiza_act_nolab <= 4, FALSE)"
TRABAJO_CUIS = [
    Rule.dummy("trabajo", f"coalesce(realiza_act_lab <= 3, FALSE) OR {_ACTIVE}"),
    Rule.cases(
        "pea",
        (f"edad >= 16 AND {yes('trabajo', 1)}", 1),
        (f"edad >= 16 AND {yes('realiza_act_lab', 5, 6)} AND {_ACTIVE}", 2),
        (f"edad >= 16 AND {yes('realiza_act_nolab', 5, 6)} AND {yes('realiza_act_lab', 5)}", 0),
    ),
    Rule.cases(
        "tipo_trab",
        (yes("trabaja_subord", 1), 1),
        (f"{yes('trabaja_indep', 1)} OR ({_ACTIVE} AND {yes('con_sueldo', 1)})", 2),
        (f"{yes('trabaja_indep', 1)} AND {yes('con_sueldo', 0)}", 3),
    ),
    Rule.dummy("jubilado", "jubilado = 1"),
]

# --- health and social security ---------------------------------------------------------------------
_SCHEME = "(am_imss = 1 OR am_issste = 1 OR am_issste_estatal = 1 OR am_pemex = 1)"
_NO_OTHER = " AND ".join(
    f"{c} IS NULL"
    for c in [
        "am_imss", "am_pemex", "am_otra", "inscrito_prestacion_lab", "inscrito_jubilacion", "inscrito_familiar",
        "inscrito_muerte_aseg", "inscrito_estudiante", "inscrito_familiar_otro",
    ]
)


def _own_contract_only(state_code: int) -> str:
    """Covered by a contract of their own with the state scheme and by nothing else."""
    return f"((am_issste = 1 OR am_issste_estatal = {state_code}) AND inscrito_contratacion = 1 AND {_NO_OTHER})"


_INSTITUTION = ["c_instsal_a", "c_instsal_b"]
_CARE = ["c_salud_hoga", "c_salud_hogb"]
_ENROLLED = ["c_afilsal_a", "c_afilsal_b"]
# Enrolment reason -> answer codes.
ENROLMENT = {
    "inscrito_prestacion_lab": (1,),
    "inscrito_jubilacion": (2, 3),
    "inscrito_familiar": (4,),
    "inscrito_muerte_aseg": (5,),
    "inscrito_estudiante": (6,),
    "inscrito_contratacion": (7,),
    "inscrito_familiar_otro": (8,),
}
SM_CV = Rule.dummy("sm_cv", f"atencion_medica = 1 AND {_SCHEME} AND inscrito_contratacion = 1 AND edad >= 12")
_ROLES = {"jefe": 1, "cony": 2, "hijo": 3}

CARENCIA_SALUD = [
    Rule.dummy("atencion_medica", yes("c_instsal_a", 99)),
    Rule.dummy("seguro_popular", yes("c_instsal_a", 1)),
    Rule.dummy("am_imss", either(_INSTITUTION, 2)),
    Rule.dummy("am_issste", either(_INSTITUTION, 3)),
    Rule("am_issste_estatal", "0"),
    Rule.dummy("am_pemex", either(_INSTITUTION, 4)),
    Rule.dummy("am_imss_prospera", either(_CARE, 3)),
    Rule.dummy("am_otra", f"{yes('c_instsal_a', 5)} OR {either(_CARE, 6, 7)}"),
    *[Rule.dummy(name, either(_ENROLLED, *codes)) for name, codes in ENROLMENT.items()],
    Rule.dummy(
        "sm_lab",
        "trabajo = 1 AND atencion_medica = 1 AND inscrito_prestacion_lab = 1 "
        f"AND (am_imss = 1 OR am_issste = 1 OR {yes('am_issste_estatal', 1)} OR am_pemex = 1)",
    ),
    SM_CV,
    Rule.dummy("salud_dir", "(tipo_trab = 1 AND sm_lab = 1) OR (tipo_trab IN (2, 3) AND (sm_lab = 1 OR sm_cv = 1))"),
    *[
        Rule.dummy(f"{role}_sm", f"parentesco = {code} AND salud_dir = 1 AND NOT {_own_contract_only(1)}")
        for role, code in _ROLES.items()
    ],
    *[Rule.grouped(f"acceso_{role}_sm", "max", f"{role}_sm", HOME) for role in _ROLES],
    Rule.dummy(
        "acceso_otros_sm",
        f"atencion_medica = 1 AND {_SCHEME} AND atencion_medica IS NOT NULL "
        "AND (inscrito_familiar = 1 OR inscrito_muerte_aseg = 1 OR inscrito_familiar_otro = 1)",
    ),
    Rule.dummy(
        "asalud",
        "salud_dir = 1 OR acceso_otros_sm = 1 OR seguro_popular = 1 OR segvol_medico = 1 "
        "OR (parentesco = 1 AND (acceso_cony_sm = 1 OR (pea = 0 AND acceso_hijo_sm = 1))) "
        "OR (parentesco = 2 AND (acceso_jefe_sm = 1 OR (pea = 0 AND acceso_hijo_sm = 1))) "
        "OR (parentesco = 3 AND (acceso_jefe_sm = 1 OR acceso_cony_sm = 1) "
        "AND (edad < 16 OR (edad BETWEEN 16 AND 25 AND asiste_escuela = 1))) "
        "OR (parentesco = 4 AND pea = 0 AND (acceso_jefe_sm = 1 OR acceso_cony_sm = 1)) "
        "OR (seguro_popular = 0 AND atencion_medica = 1 AND (am_imss = 1 OR am_issste = 2 "
        "OR am_issste_estatal = 1 OR am_pemex = 1 OR am_imss_prospera = 1 OR am_otra = 6))",
    ),
    Rule.dummy("ic_asalud", "asalud = 0 OR asalud IS NULL"),
]

_SIX_MONTH_MEAN = "(ing_1 + ing_2 + ing_3 + ing_4 + ing_5 + ing_6) / 6.0e0"
INGRESOS_ENIGH = [
    Rule("ingreso_pam_temp", _SIX_MONTH_MEAN, where="clave IN ('P044', 'P045')"),
    Rule.grouped("ingreso_pam", "sum", "ingreso_pam_temp", PERSON),
    Rule.dummy("pam", "edad >= 65 AND coalesce(ingreso_pam > 0, FALSE)"),
    Rule("ingreso_pens_temp", _SIX_MONTH_MEAN, where="clave IN ('P032', 'P033')"),
    Rule.grouped("ingreso_pens", "sum", "ingreso_pens_temp", PERSON),
]
INGRESOS_CUIS = [
    Rule.dummy("pam", either(["am_a", "am_b", "am_c"], 1)),
    Rule("ingreso_pens", "0"),
]

_COVER = f"({yes('sm_lab', 1)} OR {yes('sm_cv', 1)})"
CARENCIA_SEGURIDAD_SOCIAL = [
    Rule.dummy("sm_lab", f"trabajo = 1 AND atencion_medica = 1 AND {_SCHEME} AND inscrito_prestacion_lab = 1"),
    Rule.dummy("jubilado", f"jubilado = 1 OR coalesce(ingreso_pens > 0, FALSE) OR {yes('inscrito_jubilacion', 1)}"),
    SM_CV,
    Rule.dummy("afore_cv", "segvol_afore = 1 AND edad >= 12"),
    Rule.dummy(
        "ss_dir",
        f"({yes('tipo_trab', 1)} AND {yes('sm_lab', 1)} AND {yes('prestacion_incapacidad', 1)} AND {yes('prestacion_afore', 1)}) "
        f"OR ({yes('tipo_trab', 2)} AND {_COVER} AND ({yes('prestacion_afore', 1)} OR {yes('afore_cv', 1)})) "
        f"OR ({yes('tipo_trab', 3)} AND {_COVER} AND {yes('afore_cv', 1)}) OR jubilado = 1",
    ),
    *[
        Rule.dummy(f"{role}_ss", f"parentesco = {code} AND ss_dir = 1{extra} AND NOT {_own_contract_only(3)}")
        for (role, code), extra in zip(_ROLES.items(), ["", "", " AND (jubilado = 0 OR (jubilado = 1 AND edad > 25))"])
    ],
    *[Rule.grouped(f"acceso_{role}_ss", "max", f"{role}_ss", HOME) for role in _ROLES],
    Rule.dummy(
        "acceso_otros_ss",
        f"atencion_medica = 1 AND {_SCHEME} AND (inscrito_familiar = 1 OR inscrito_muerte_aseg = 1 "
        "OR inscrito_contratacion = 1 OR inscrito_familiar_otro = 1)",
    ),
    Rule.dummy(
        "seguridad_social",
        f"ss_dir = 1 OR acceso_otros_ss = 1 OR {yes('pam', 1)} "
        f"OR (parentesco = 1 AND (acceso_cony_ss = 1 OR ({yes('pea', 0)} AND acceso_hijo_ss = 1))) "
        f"OR (parentesco = 2 AND (acceso_jefe_ss = 1 OR ({yes('pea', 0)} AND acceso_hijo_ss = 1))) "
        "OR (parentesco = 3 AND (acceso_jefe_ss = 1 OR acceso_cony_ss = 1) "
        f"AND (edad < 16 OR (edad BETWEEN 16 AND 25 AND {yes('asiste_escuela', 1)}))) "
        f"OR (parentesco = 4 AND {yes('pea', 0)} AND acceso_jefe_ss = 1) "
        f"OR (parentesco = 5 AND {yes('pea', 0)} AND acceso_cony_ss = 1)",
    ),
    Rule.dummy("ic_seguridad_social", yes("seguridad_social", 0)),
]

DEPRIVATION = {
    "rezago_educativo": REZAGO_EDUCATIVO,
    "carencia_servicios": CARENCIA_SERVICIOS,
    "carencia_vivienda": CARENCIA_VIVIENDA,
    "carencia_alimentaria": CARENCIA_ALIMENTARIA,
    "trabajo_enigh": TRABAJO_ENIGH,
    "trabajo_cuis": TRABAJO_CUIS,
    "carencia_salud": CARENCIA_SALUD,
    "ingresos_enigh": INGRESOS_ENIGH,
    "ingresos_cuis": INGRESOS_CUIS,
    "carencia_seguridad_social": CARENCIA_SEGURIDAD_SOCIAL,
}
