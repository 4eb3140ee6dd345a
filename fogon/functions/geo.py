"""Provinces and distances as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIN_UBICACION = "Sin Ubicación"

# Province boxes (lat min, lat max, lng min, lng max), tested in this order,
# first match wins although the boxes overlap.
CAJAS_PROVINCIA = [
    ("San José", 9.6, 10.1, -85.0, -84.0),
    ("Cartago", 9.7, 10.2, -84.4, -83.6),
    ("Heredia", 9.9, 10.5, -84.6, -84.0),
    ("Alajuela", 10.0, 10.9, -85.0, -84.1),
    ("Guanacaste", 10.2, 11.2, -86.0, -84.5),
    ("Puntarenas", 8.5, 11.0, -85.9, -84.4),
    ("Limón", 8.5, 11.2, -84.2, -82.5),
]
PROVINCIAS = [caja[0] for caja in CAJAS_PROVINCIA]

# Fixed value: Earth radius in km.
RADIO_TIERRA_KM = 6371


def provincia(lat: Column, lng: Column) -> Column:
    lat, lng = lat.cast("double"), lng.cast("double")
    nombre = F.lit(SIN_UBICACION)
    for caja, lat_min, lat_max, lng_min, lng_max in reversed(CAJAS_PROVINCIA):
        dentro = lat.between(lat_min, lat_max) & lng.between(lng_min, lng_max)
        nombre = F.when(dentro, caja).otherwise(nombre)
    return nombre


ZONAS = [*PROVINCIAS, SIN_UBICACION]


def zona(lat: Column, lng: Column) -> Column:
    """Number of the province in ZONAS, from 1: rows that are shuffled carry it for less than its name."""
    return F.array_position(F.array(*map(F.lit, ZONAS)), provincia(lat, lng)).cast("byte")


def nombre_zona(n: Column) -> Column:
    return F.get(F.array(*map(F.lit, ZONAS)), n.cast("int") - 1)


def distancia_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Spherical law of cosines; the cosine is clamped so that equal points give 0, not NaN."""
    a, b = F.radians(lat1), F.radians(lat2)
    coseno = F.cos(a) * F.cos(b) * F.cos(F.radians(lng2) - F.radians(lng1)) + F.sin(a) * F.sin(b)
    # least/greatest skip NULLs, so a missing coordinate has to be kept explicitly.
    acotado = F.when(coseno.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), coseno)))
    return F.acos(acotado) * RADIO_TIERRA_KM
