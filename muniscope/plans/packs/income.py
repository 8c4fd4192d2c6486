"""Household income predictors."""

from __future__ import annotations

from ...operators.rules import Rule
from .deprivation import HOME, either, yes


def people(name: str, where: str) -> Rule:
    """Number of different persons of the household meeting a condition."""
    return Rule.grouped(name, "count_distinct", "person_id", HOME, where)


EDUCACION = [
    Rule.grouped("jefe_escolaridad", "max", "aprobo_ultnivel", HOME, "parentesco IN (1, 2)"),
    Rule.dummy("p_esc3", "jefe_escolaridad >= 6 AND jefe_escolaridad < 9"),
    Rule.dummy("p_esc5", "jefe_escolaridad >= 9"),
    people("num_asiste_escuela_5a15", "asiste_escuela = 0 AND edad BETWEEN 5 AND 15"),
]

CONDICION_LABORAL = [
    Rule.grouped("jefe_edad", "max", "edad", ("hogar_id",), "parentesco = 1"),
    people("num_trabaja_subor", "trabaja_subord = 1"),
    people("num_trabaja_indep", "trabaja_indep = 1"),
    Rule.dummy("jefe_subord", "parentesco = 1 AND trabaja_subord = 1 AND trabaja_subord IS NOT NULL"),
    Rule.dummy("jefe_indep", "parentesco = 1 AND trabaja_indep = 1 AND trabaja_subord IS NOT NULL"),
    people("num_trabaja_sin_pago", "con_sueldo = 0 OR tipo_pago IN (2, 3)"),
    people("num_hombres_trabajan", "sexo = 1 AND trabajo = 1"),
    people("num_mujeres_trabajan", "sexo = 2 AND trabajo = 1"),
    Rule.dummy("hombres_trabajan_excl", "num_hombres_trabajan >= 1 AND num_mujeres_trabajan = 0"),
    people("num_menores_trabaja", "edad BETWEEN 12 AND 15 AND trabajo = 1"),
    people("num_adol_trabaja", "edad BETWEEN 16 AND 18 AND trabajo = 1"),
    people("num_trabajan", "trabajo = 1"),
    people("num_no_trabajan", "trabajo = 0"),
    Rule("depen_cociente", "CAST(num_trabajan AS DOUBLE) / nullif(num_no_trabajan, 0)", where="num_no_trabajan > 0"),
    people("num_con_sueldo", "con_sueldo = 1 AND id_trabajo = 1"),
]

_WORK_COVER = either(["am_imss", "am_issste", "am_issste_estatal", "am_pemex", "inscrito_contratacion"], 1)
SEGURIDAD_SOCIAL = [
    Rule.dummy("con_servicios_salud", _WORK_COVER),
    Rule.grouped("num_seguro_popular", "sum", "seguro_popular", HOME),
    Rule.dummy("con_seguro_popular", yes("seguro_popular", 1)),
    Rule.dummy("ssjtrabind", _WORK_COVER, where="parentesco = 1 AND trabaja_indep = 1 AND trabaja_subord IS NOT NULL"),
]

CONDICIONES_VIVIENDA = [
    Rule.dummy("piso_tierra", "material_pisos = 1"),
    Rule.dummy("piso_firme", "material_pisos >= 2"),
    Rule.dummy("piso_rec", "material_pisos = 3"),
    Rule.dummy("techo_blando", "material_techos <= 6"),
    Rule.dummy("pared_blando", "material_muros <= 5"),
    Rule.dummy("sin_agua", "servicio_agua <= 5"),
    Rule.dummy("sin_basurero", "elimina_basura <= 5"),
    Rule.dummy("no_sanitario", "tipo_escusado = 1"),
    Rule.dummy("sin_sanitario", "no_sanitario = 1"),
    Rule.dummy("sanitario_cagua", "tipo_escusado = 5"),
    Rule.dummy("sanitario_cagua_excl", "sanitario_cagua = 1 AND escusado_exclusivo = 1"),
    Rule.dummy("sin_combustible", "fuente_combustible = 1"),
    Rule.dummy("viv_propia_integrante", "tenencia IN (2, 5, 6)"),
    Rule.dummy("tenencia_propia", "tenencia >= 5"),
    Rule.dummy("viv_renta", "tenencia = 4"),
    Rule("total_cuartosdor", "total_cuartosdor"),
    Rule("int_techo_piso", "piso_tierra * techo_blando"),
]

CONDICIONES_DEMOGRAFICAS1 = [
    Rule("total_personas", "total_personas"),
    Rule.dummy("unipersonales", "total_personas = 1"),
    Rule("log_total_personas", "ln(nullif(CAST(total_personas AS DOUBLE), 0))"),
    Rule("cuartos_dormir", "total_cuartosdor"),
    Rule("hacinamiento", "CAST(total_personas AS DOUBLE) / nullif(cuartos_dormir, 0)", where="cuartos_dormir > 0"),
]

_DISABILITY = ["disc2", "disc3", "disc4", "disc5", "disc6", "disc7"]
CONDICIONES_DEMOGRAFICAS2 = [
    people("num_dependientes", "edad <= 15 OR edad >= 65"),
    people("num_independientes", "edad BETWEEN 16 AND 64"),
    Rule(
        "dependientes_cociente",
        "CAST(num_dependientes AS DOUBLE) / nullif(num_independientes, 0)",
        where="num_independientes > 0",
    ),
    people("num_mujeres", "sexo = 2"),
    people("num_hombres", "sexo = 1"),
    Rule.dummy("mas_mujeres", "num_mujeres > num_hombres"),
    Rule.dummy("solo_mujeres", "num_mujeres >= 1 AND num_hombres = 0"),
    people("num_mujeres_15a49", "sexo = 2 AND edad BETWEEN 15 AND 49"),
    people("num_edad0a5", "edad <= 5"),
    Rule.dummy("con_edad0a5", "num_edad0a5 = 1"),
    people("num_adultos_mayores", "edad >= 65"),
    Rule.dummy("habla_lenguaind", "lengua_indigena > 0"),
    people("num_exc_lengua_indigena", "habla_lenguaind = 1 AND habla_espanol = 0"),
    Rule.dummy("exc_lengua_indigena", "habla_lenguaind = 1 AND habla_espanol = 0"),
    Rule.dummy("jefe_mayor40", "parentesco = 1 AND edad >= 40"),
    Rule.dummy("jefatura_femenina", "parentesco = 1 AND sexo = 2"),
    Rule.dummy("recibe_remesas", "remesas > 0"),
    Rule.dummy("con_remesa", "recibe_remesas = 1"),
    Rule.dummy("c_discapacidad", "coalesce(disc1 <> 8, FALSE) OR " + " OR ".join(f"{d} IS NOT NULL" for d in _DISABILITY)),
]

# Appliance -> counts that show the household owns one.
APPLIANCES = {
    "refrigerador": ["num_refri"],
    "vehiculo": ["num_auto", "num_van", "num_pickup"],
    "videocas": ["num_video"],
    "computadora": ["num_compu"],
    "horno": ["num_micro"],
    "lavadora": ["num_lavad"],
    "estufa": ["num_estuf"],
    "telefono": [],
}


def appliance(name: str, counts: list[str]) -> list[Rule]:
    """Owned, working, three-state (3 works, 2 broken, 1 none), and lacking. ``telefono`` is asked directly."""
    owned = [Rule.dummy(name, " OR ".join(f"{c} >= 1" for c in counts))] if counts else []
    return [
        *owned,
        Rule.dummy(f"{name}_sirve", f"{name} = 1"),
        Rule.cases(
            f"ts_{name}",
            (f"{name} = 1 AND {name}_sirve = 1", 3),
            (f"{name} = 1 AND {name}_sirve = 0", 2),
            (f"{name} = 0", 1),
        ),
        Rule.dummy(f"sin_{name}", f"ts_{name} = 1"),
    ]


ENSERES_HOGAR = [
    *[r for name, counts in APPLIANCES.items() for r in appliance(name, counts)],
    Rule("int_videocas_horno", "sin_videocas * sin_horno"),
]

SEGURIDAD_ALIMENTARIA = [
    Rule.dummy("inseg_alim", yes("alim_dejocomida", 1)),
    Rule.dummy("sin_alim", either(["alim_dejocomida", "alim_comiouna"], 1)),
    Rule.dummy("seg_alim_a", either(["alim_comiouna", "alim_dejocomida", "alim_nocomio"], 1)),
]

INCOME = {
    "educacion": EDUCACION,
    "condicion_laboral": CONDICION_LABORAL,
    "seguridad_social": SEGURIDAD_SOCIAL,
    "condiciones_vivienda": CONDICIONES_VIVIENDA,
    "condiciones_demograficas1": CONDICIONES_DEMOGRAFICAS1,
    "condiciones_demograficas2": CONDICIONES_DEMOGRAFICAS2,
    "enseres_hogar": ENSERES_HOGAR,
    "seguridad_alimentaria": SEGURIDAD_ALIMENTARIA,
}
