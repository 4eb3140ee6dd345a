"""Explicit schemas of the document source and of the warehouse tables (column name → SQL type)."""

DINERO = "DECIMAL(10,2)"
_LAT, _LNG = "DECIMAL(10,8)", "DECIMAL(11,8)"


def ddl(columnas: dict[str, str]) -> str:
    return ", ".join(f"{nombre} {tipo}" for nombre, tipo in columnas.items())


LINEA = "STRUCT<id_producto: BIGINT, cantidad: INT, subtotal: DOUBLE>"
PEDIDO_DOC = ddl({
    "id_pedido": "BIGINT", "id_usuario": "BIGINT", "id_restaurante": "BIGINT", "id_repartidor": "BIGINT",
    "fecha_hora": "STRING", "estado": "STRING", "tipo": "STRING", "detalles": f"ARRAY<{LINEA}>",
})
RESERVA_DOC = ddl({
    "id_reserva": "BIGINT", "id_usuario": "BIGINT", "id_restaurante": "BIGINT", "fecha_hora": "STRING", "estado": "STRING",
})
USUARIO_API = "STRUCT<id_usuario: BIGINT, nombre: STRING, latitud: DOUBLE, longitud: DOUBLE, id_referido: BIGINT>"
RESPUESTA_USUARIOS = ddl({"message": "STRING", "total": "BIGINT", "usuarios": f"ARRAY<{USUARIO_API}>"})
ELEMENTO_OSM = "STRUCT<type: STRING, lat: DOUBLE, lon: DOUBLE, tags: MAP<STRING, STRING>>"
ARCHIVO_OSM = ddl({"elements": f"ARRAY<{ELEMENTO_OSM}>"})

DIMENSIONES = {
    "dim_tiempo": {
        "tiempo_id": "BIGINT", "fecha": "STRING", "hora": "INT", "minuto": "INT", "anio": "INT", "mes": "INT", "dia": "INT",
        "trimestre": "INT", "dia_semana": "INT", "es_fin_semana": "BOOLEAN", "es_horario_pico": "BOOLEAN",
    },
    "dim_ubicacion": {
        "ubicacion_id": "INT", "provincia": "STRING", "latitud_min": _LAT, "latitud_max": _LAT, "longitud_min": _LNG,
        "longitud_max": _LNG, "es_zona_activa": "BOOLEAN", "descripcion": "STRING",
    },
    "dim_categorias": {"categoria_id": "INT", "nombre_categoria": "STRING"},
    "dim_productos": {
        "producto_id": "BIGINT", "nombre": "STRING", "categoria_id": "INT", "precio_actual": DINERO,
        "precio_promedio": DINERO, "id_menu": "BIGINT", "id_restaurante": "BIGINT", "activo": "BOOLEAN",
        "fecha_ultima_actualizacion": "STRING", "fuente_datos": "STRING",
    },
}
_ORIGEN = {"fecha_creacion": "STRING", "fecha_etl": "STRING", "fuente_datos": "STRING", "anio": "INT", "mes": "INT"}
HECHOS = {
    "fact_pedidos": {
        "id_pedido": "BIGINT", "tiempo_id": "BIGINT", "id_usuario": "BIGINT", "id_restaurante": "BIGINT",
        "id_repartidor": "BIGINT", "estado": "STRING", "tipo": "STRING", "total_pedido": DINERO, "cantidad_items": "INT",
        "usuario_latitud": _LAT, "usuario_longitud": _LNG, "restaurante_latitud": _LAT, "restaurante_longitud": _LNG,
        "provincia_cliente": "STRING", "provincia_restaurante": "STRING", **_ORIGEN,
    },
    "fact_reservas": {
        "id_reserva": "BIGINT", "tiempo_id": "BIGINT", "id_usuario": "BIGINT", "id_restaurante": "BIGINT",
        "estado": "STRING", **_ORIGEN,
    },
    "fact_detalle_pedidos": {
        "id_pedido": "BIGINT", "id_producto": "BIGINT", "tiempo_id": "BIGINT", "categoria_id": "INT",
        "id_usuario": "BIGINT", "id_restaurante": "BIGINT", "id_repartidor": "BIGINT", "estado_pedido": "STRING",
        "tipo_pedido": "STRING", "cantidad": "INT", "precio_unitario": DINERO, "subtotal": DINERO,
        "provincia_cliente": "STRING", "provincia_restaurante": "STRING", **_ORIGEN,
    },
}
TABLAS = {**DIMENSIONES, **HECHOS}
PARTICIONES = ["anio", "mes"]

# Natural keys: a row whose key is already in the warehouse is not loaded again.
CLAVES = {
    "fact_pedidos": ["id_pedido", "fuente_datos"],
    "fact_reservas": ["id_reserva", "fuente_datos"],
    "fact_detalle_pedidos": ["id_pedido", "id_producto", "fuente_datos"],
    "dim_productos": ["producto_id", "fuente_datos"],
    "dim_tiempo": ["fecha", "hora", "minuto"],
    "dim_categorias": ["nombre_categoria"],
}

# Tables of the relational source.
RELACIONALES = ["usuario", "restaurante", "repartidor", "menu", "producto", "reserva", "pedido", "detalle"]
