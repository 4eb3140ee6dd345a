"""Calendar attributes of an event time.

Event times are TIMESTAMP_NTZ (wall clock), so no expression here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Peak hours (inclusive) and weekend days (Monday = 1).
HORAS_PICO = [(11, 14), (18, 21)]
DIAS_FIN_SEMANA = [6, 7]

# Labels.
NOMBRES_DIA = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
NOMBRES_TRIMESTRE = ["Q1 (Ene-Mar)", "Q2 (Abr-Jun)", "Q3 (Jul-Sep)", "Q4 (Oct-Dic)"]


def to_event_ts(col: Column) -> Column:
    """Wall-clock time from a timestamp or ISO text; a trailing ``Z`` or offset is dropped."""
    texto = F.regexp_replace(F.trim(col.cast("string")), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return texto.try_cast("timestamp_ntz")


def epoch_minutes(ts: Column) -> Column:
    """Minutes since 1970 of the wall clock, out of its date and time fields."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)


def epoch_seconds(ts: Column) -> Column:
    return epoch_minutes(ts) * 60 + F.second(ts)


def fecha(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def iso_text(ts: Column) -> Column:
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def dia_semana(ts: Column) -> Column:
    return F.weekday(ts) + 1


def es_fin_semana(ts: Column) -> Column:
    return dia_semana(ts).isin(DIAS_FIN_SEMANA)


def es_horario_pico(hora: Column) -> Column:
    tramos = [hora.between(desde, hasta) for desde, hasta in HORAS_PICO]
    return tramos[0] | tramos[1]


def etiqueta(valor: Column, nombres: list[str], otro: str | None = None) -> Column:
    """Label of a 1-based code."""
    return F.coalesce(F.try_element_at(F.array(*map(F.lit, nombres)), valor.cast("int")), F.lit(otro))


def nombre_dia(dia: Column) -> Column:
    return etiqueta(dia, NOMBRES_DIA)


def atributos_tiempo(tiempo_id: Column) -> dict[str, Column]:
    """Attributes of a minute of the time dimension out of its id, which counts seconds of the wall clock since 1970."""
    dia = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(tiempo_id / 86400).cast("int"))
    resto = F.pmod(tiempo_id, F.lit(86400))
    hora = F.floor(resto / 3600).cast("int")
    return {
        "fecha": dia.cast("string"), "hora": hora, "minuto": F.floor(resto % 3600 / 60).cast("int"), "anio": F.year(dia),
        "mes": F.month(dia), "dia": F.day(dia), "trimestre": F.quarter(dia), "dia_semana": dia_semana(dia),
        "es_fin_semana": es_fin_semana(dia), "es_horario_pico": es_horario_pico(hora),
    }


def periodo_dia(hora: Column) -> Column:
    return (
        F.when(hora.between(6, 11), "Mañana (6-11)")
        .when(hora.between(12, 17), "Tarde (12-17)")
        .when(hora.between(18, 23), "Noche (18-23)")
        .otherwise("Madrugada (0-5)")
    )
