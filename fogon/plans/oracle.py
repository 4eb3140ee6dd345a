"""SQL twins of the registered queries, run by DuckDB straight on the given tables.

They do not follow the engine's path: no warehouse, no surrogate lookups, no pre-aggregation. Each text is
the needed common tables (with what those need) followed by one SELECT.
"""

from __future__ import annotations

import re

from fogon.functions.calendar import NOMBRES_DIA, NOMBRES_TRIMESTRE
from fogon.functions.geo import CAJAS_PROVINCIA, PROVINCIAS
from fogon.sources.warehouse import UBICACIONES


def r(expr: str, digits: int = 2) -> str:
    """Half-up rounding of a double by its shortest decimal text."""
    return f"cast(round(cast(cast(cast({expr} as double) as varchar) as decimal(38,15)), {digits}) as double)"


def dbl(expr: str) -> str:
    return f"cast({expr} as double)"


def div(a: str, b: str) -> str:
    return f"({dbl(a)} / nullif({dbl(b)}, 0))"


def pct(a: str, b: str, digits: int = 2) -> str:
    return r(f"{dbl(a)} * 100.0 / nullif({dbl(b)}, 0)", digits)


def n_si(cond: str) -> str:
    return f"count(*) filter (where {cond})"


def cuantos(col: str, **valores: str) -> str:
    return ", ".join(f"{n_si(f'''{col} = '{v}' ''')} as {n}" for n, v in valores.items())


def prov(lat: str, lng: str) -> str:
    casos = " ".join(
        f"when {lat} between {a} and {b} and {lng} between {c} and {d} then '{n}'" for n, a, b, c, d in CAJAS_PROVINCIA
    )
    return f"case {casos} else 'Sin Ubicación' end"


def km(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    c = (f"cos(radians({lat1})) * cos(radians({lat2})) * cos(radians({lng2}) - radians({lng1}))"
         f" + sin(radians({lat1})) * sin(radians({lat2}))")
    return f"6371 * acos(case when {c} > 1 then 1.0 when {c} < -1 then -1.0 else {c} end)"


def etiquetas(col: str, nombres: list[str]) -> str:
    return f"case {col} " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(nombres, 1)) + " end"


ATRIBUTOS = """cast(cast(ts as date) as varchar) as fecha, cast(year(ts) as int) as anio, cast(month(ts) as int) as mes,
 cast(quarter(ts) as int) as trimestre, cast(isodow(ts) as int) as dia_semana, isodow(ts) >= 6 as es_fin_semana,
 cast(hour(ts) as int) as hora, (hour(ts) in (11, 12, 13, 14, 18, 19, 20, 21)) as es_horario_pico"""
DIA = "fecha, anio, mes, trimestre, dia_semana, es_fin_semana"
FUENTES = "(values ('postgres'), ('mongo')) f(source_db)"

TABLAS = {
    "usuario": """select c_custkey as id_usuario, c_name as nombre,
 'cliente' || case when c_custkey % 100 = 99 then c_custkey - 1 else c_custkey end || '@correo.cr' as email,
 case when c_mktsegment = 'MACHINERY' then 'administrador' else 'cliente' end as rol,
 timestamp '2020-01-01' + to_days(cast(c_custkey * 7 % 1000 as int)) as fecha_registro,
 case when c_custkey % 50 <> 0 then 8.5::double + (c_custkey * 37 % 280)::double / 100.0::double end as latitud,
 -86.0::double + (c_custkey * 53 % 350)::double / 100.0::double as longitud, c_mktsegment as direccion_completa,
 case when c_custkey >= 10 and c_custkey % 10 < 7 then (c_custkey * 31 + 7) % (1 + c_custkey // 3) end as id_referido
 from customer""",
    "restaurante": """select s_suppkey as id_restaurante, s_name as nombre, 'Calle ' || s_nationkey as direccion,
 s_suppkey * 15 as id_admin, 9.0::double + (s_suppkey * 41 % 200)::double / 100.0::double as latitud,
 -85.5::double + (s_suppkey * 67 % 250)::double / 100.0::double as longitud from supplier""",
    "repartidor": """select s_suppkey as id_repartidor, s_name as nombre, '8' || lpad(s_suppkey::varchar, 7, '0') as telefono,
 case when s_suppkey % 2 = 0 then 'moto' else 'bicicleta' end as vehiculo,
 9.7::double + (s_suppkey * 17 % 40)::double / 100.0::double as latitud_actual,
 -84.4::double + (s_suppkey * 29 % 80)::double / 100.0::double as longitud_actual,
 case s_suppkey % 3 when 0 then 'ocupado' else 'disponible' end as estado from supplier""",
    "menu": """select distinct p_partkey % 40 as id_menu, p_partkey % 10 as id_restaurante,
 'Menú ' || (p_partkey % 40) as nombre from part""",
    "producto": """select p_partkey as id_producto, p_partkey % 40 as id_menu, p_name as nombre,
 case p_type when 'SMALL' then 'Bebida' when 'STANDARD' then 'Plato principal' when 'MEDIUM' then 'Postre'
 when 'LARGE' then 'Entrada' when 'ECONOMY' then 'Combo' else '' end as categoria,
 p_retailprice as precio, p_brand as descripcion from part""",
    "detalle": """select l_orderkey as id_pedido, l_linenumber as id_detalle, l_partkey as id_producto,
 cast(l_quantity as int) as cantidad, l_extendedprice as subtotal,
 case when l_orderkey % 3 = 0 then 'mongo' else 'postgres' end as fuente_datos from lineitem""",
    "pedido": """select o_orderkey as id_pedido, o_custkey as id_usuario, x.id_restaurante,
 case when o_orderkey % 4 <> 0 then o_custkey // 15 end as id_repartidor,
 o_orderdate + to_minutes(cast(o_orderkey * 17 % 1440 as int)) as fecha_hora,
 case when o_orderstatus = 'F' then 'entregado' when o_orderstatus = 'P' then 'pendiente'
 when o_orderkey % 2 = 0 then 'en preparacion' else 'listo' end as estado,
 case when left(o_orderpriority, 1) in ('1', '2') then 'en restaurante' else 'para recoger' end as tipo,
 case when o_orderkey % 3 = 0 then 'mongo' else 'postgres' end as fuente_datos
 from orders left join (select l_orderkey, min(l_suppkey) as id_restaurante from lineitem group by 1) x
 on l_orderkey = o_orderkey""",
    "reserva": """select event_id as id_reserva, user_id as id_usuario, event_id % 10 as id_restaurante, ts as fecha_hora,
 case event_type when 'click' then 'pendiente' when 'error' then 'cancelada' else 'confirmada' end as estado,
 case when event_id % 3 = 0 then 'mongo' else 'postgres' end as fuente_datos from events""",
    # Facts with the attributes of their minute.
    "fp": f"""select p.id_pedido, p.id_usuario, p.id_restaurante, p.id_repartidor, p.fecha_hora as ts, p.estado, p.tipo,
 p.fuente_datos, coalesce(t.total, 0) as total_pedido, coalesce(t.items, 0) as cantidad_items,
 u.latitud as ulat, u.longitud as ulng, r.latitud as rlat, r.longitud as rlng,
 {prov('u.latitud', 'u.longitud')} as provincia_cliente, {prov('r.latitud', 'r.longitud')} as provincia_restaurante,
 {ATRIBUTOS.replace('(ts)', '(p.fecha_hora)').replace('(ts as', '(p.fecha_hora as')}
 from @pedido p left join @usuario u using (id_usuario) left join @restaurante r using (id_restaurante)
 left join (select id_pedido, sum(cast(subtotal as decimal(18,2))) as total, sum(cantidad) as items from @detalle group by 1) t
 using (id_pedido)""",
    "fr": f"""select id_reserva, id_usuario, id_restaurante, fecha_hora as ts, estado, fuente_datos,
 {ATRIBUTOS.replace('(ts)', '(fecha_hora)').replace('(ts as', '(fecha_hora as')} from @reserva""",
    "fd": """select d.id_pedido, d.id_producto, d.cantidad, cast(d.subtotal as decimal(18,2)) as subtotal, p.fuente_datos,
 case when p.fuente_datos = 'postgres' then cast(pr.precio as decimal(18,2))
  else cast(""" + r('d.subtotal / d.cantidad') + """ as decimal(18,2)) end
  as precio_unitario,
 case when pr.categoria <> '' then pr.categoria when p.fuente_datos = 'postgres' then 'Sin categoría' else 'Especialidad' end
  as nombre_categoria,
 pr.nombre, pr.precio, pr.id_menu, p.estado as estado_pedido, p.tipo as tipo_pedido,
 p.* exclude (id_pedido, fuente_datos, estado, tipo)
 from @detalle d join @fp p on p.id_pedido = d.id_pedido join @producto pr on pr.id_producto = d.id_producto""",
    "vp": "select * from @fp where total_pedido > 0",
    "vd": "select * from @fd where subtotal > 0",
    "minutos": """select date_trunc('minute', fecha_hora) as m, min(fecha_hora) as ts from
 (select fecha_hora from @pedido union all select fecha_hora from @reserva) group by 1""",
    "dias": f"select distinct {DIA} from (select {ATRIBUTOS} from @minutos)",
    "categorias": """select row_number() over (order by nombre_categoria) as categoria_id, nombre_categoria
 from (select distinct nombre_categoria from @fd)""",
    # Graph.
    "nu": f"""select id_usuario, source_db, nombre, coalesce(latitud, 0.0::double) as latitud,
 coalesce(longitud, 0.0::double) as longitud, id_referido from @usuario, {FUENTES}""",
    "np": f"select id_producto, source_db, nombre, categoria, precio from @producto, {FUENTES}",
    "nr": f"select id_restaurante, source_db, nombre, latitud, longitud from @restaurante, {FUENTES}",
    "nd": f"select id_repartidor, source_db, nombre, latitud_actual, longitud_actual, estado from @repartidor, {FUENTES}",
    "npe": "select id_pedido, fuente_datos as source_db, estado, tipo from @pedido",
    "contiene": """select id_pedido, id_producto, fuente_datos as source_db, max_by(cantidad, id_detalle * 1000 + cantidad) as cantidad
 from @detalle group by all""",
    "proviene": """select distinct id_pedido, id_restaurante, fuente_datos as source_db from @pedido
 where id_restaurante in (select id_restaurante from @restaurante)""",
    "pertenece": """select distinct id_pedido, id_usuario, fuente_datos as source_db from @pedido
 where id_usuario in (select id_usuario from @usuario)""",
    "asignado": """select distinct id_pedido, id_repartidor, fuente_datos as source_db from @pedido
 where id_repartidor in (select id_repartidor from @repartidor)""",
    "refiere": """select b.id_referido as id_referente, b.id_usuario as id_referido, b.source_db from @nu a
 join @nu b on a.id_usuario = b.id_referido and a.source_db = b.source_db""",
    "pares": """select a.id_producto as p1, b.id_producto as p2, a.source_db, count(distinct a.id_pedido) as frecuencia
 from @contiene a join @contiene b on a.id_pedido = b.id_pedido and a.id_producto <> b.id_producto group by all""",
    "cc": """select p1 as id_producto1, p2 as id_producto2, x.source_db, frecuencia,
 frecuencia::double / (select count(*) from @npe n where n.source_db = x.source_db)::double as support,
 frecuencia::double / (select count(distinct id_pedido) from @contiene c where c.id_producto = p1 and c.source_db = x.source_db)
  ::double as confidence from @pares x""",
    "ccn": """select c.*, a.nombre as n1, b.nombre as n2, a.categoria as c1, b.categoria as c2, a.precio as precio1, b.precio as precio2
 from @cc c join @producto a on a.id_producto = c.id_producto1 join @producto b on b.id_producto = c.id_producto2""",
    "refs": """select u.*, (select count(*) from @refiere r where r.id_referente = u.id_usuario and r.source_db = u.source_db)
 as total_referidos from @nu u""",
    "niveles": """select *, case when total_referidos > 5 then 'Alto' when total_referidos > 2 then 'Medio'
 when total_referidos > 0 then 'Bajo' else 'Sin referidos' end as nivel_influencia from @refs""",
    "dist10": f"""select * from (select r.source_db, r.id_restaurante, r.nombre as restaurante, d.id_repartidor,
 d.nombre as repartidor, d.latitud_actual as latitud, d.longitud_actual as longitud,
 {km('r.latitud', 'r.longitud', 'd.latitud_actual', 'd.longitud_actual')} as distancia_km,
 row_number() over (partition by r.source_db, r.id_restaurante order by round({km('r.latitud', 'r.longitud', 'd.latitud_actual', 'd.longitud_actual')}, 9), d.id_repartidor) as puesto
 from @nr r join @nd d on r.source_db = d.source_db and d.estado = 'disponible') where puesto <= 10""",
    "dist": "select * from @dist10 where puesto <= 5",
    "paradas": """select distinct p.fuente_datos as source_db, p.id_repartidor, u.id_usuario, u.nombre, u.latitud, u.longitud,
 d.latitud_actual, d.longitud_actual from @pedido p join @nu u on u.id_usuario = p.id_usuario and u.source_db = p.fuente_datos
 join @nd d on d.id_repartidor = p.id_repartidor and d.source_db = p.fuente_datos where p.estado <> 'entregado'""",
    "entrega": f"""select source_db, id_repartidor, id_usuario, nombre, latitud, longitud,
 {km('latitud_actual', 'longitud_actual', 'latitud', 'longitud')} as distancia_km from @paradas""",
    # Search.
    "indice": """select id_producto, nombre, categoria, coalesce(nullif(descripcion, ''), 'Producto sin descripción') as descripcion,
 precio, id_menu from @producto""",
    "palabras": """select id_producto, campo, unnest(regexp_extract_all(lower(texto), '[\\p{L}\\p{N}]+')) as token from
 (select id_producto, unnest(['nombre', 'categoria', 'descripcion']) as campo, unnest([nombre, categoria, descripcion]) as texto
  from @indice)""",
    "tf": """select id_producto, campo, token, count(*) as tf,
 sum(count(*)) over (partition by id_producto, campo) as largo from @palabras group by 1, 2, 3""",
}

# Query results that other queries build on.
_INGRESOS = "coalesce(cast(sum(total_pedido) as double), 0)"
_TICKET = div("sum(total_pedido)", "count(total_pedido)")
_TICKET2 = r(_TICKET)
_MONTO = "coalesce(cast(sum(subtotal) as double), 0)"
_PRECIO = div("sum(precio_unitario)", "count(precio_unitario)")
_ESTADOS = cuantos("estado", pedidos_entregados="entregado", pedidos_pendientes="pendiente",
                   pedidos_preparacion="en preparacion", pedidos_listos="listo")
_TIPOS = cuantos("tipo", pedidos_restaurante="en restaurante", pedidos_recoger="para recoger")


def _fuentes(prefijo: str) -> str:
    return cuantos("fuente_datos", **{f"{prefijo}_postgres": "postgres", f"{prefijo}_mongo": "mongo"})


_LOCAL, _EXTERNO = "provincia_cliente = provincia_restaurante", "provincia_cliente <> provincia_restaurante"
_FLUJO = f"""case when {_LOCAL} then 'Local' when 'Sin Ubicación' in (provincia_cliente, provincia_restaurante)
 then 'Sin Info' else 'Inter-Provincial' end"""


def crece(a: str, b: str) -> str:
    return f"case when {b} > 0 then {r(f'({dbl(a)} - {dbl(b)}) * 100.0 / {dbl(b)}')} end"


def _tendencia(periodo: str, donde: str = "true") -> str:
    return (f"select {periodo} as periodo, count(*) as pedidos, {_INGRESOS} as ingresos, {_TICKET2} as ticket_promedio, "
            f"sum(cantidad_items) as items from @vp where {donde} group by 1")


def _geo(columna: str, monto: str, usuarios: str, restaurantes: str, externos: str) -> str:
    return (f"select {columna} as provincia, count(*) as total_pedidos, {_INGRESOS} as {monto}, {_TICKET2} as ticket_promedio, "
            f"count(distinct id_usuario) as {usuarios}, count(distinct id_restaurante) as {restaurantes}, "
            f"{pct(n_si(_EXTERNO), 'count(*)', 1)} as {externos} from @vp where {columna} <> 'Sin Ubicación' group by 1")


def _mayor(etiqueta: str, medida: str) -> str:
    return f"first({etiqueta} order by {medida} desc, {etiqueta})"


def _menor(etiqueta: str, medida: str) -> str:
    return f"first({etiqueta} order by {medida}, {etiqueta})"


Q: dict[str, str] = {
    # --- cubes ---
    "C01": f"""select {', '.join('d.' + x for x in DIA.split(', '))}, count(id_pedido) as total_pedidos, {_INGRESOS} as ingresos_totales,
 coalesce({_TICKET}, 0) as ticket_promedio, coalesce(sum(cantidad_items), 0) as items_vendidos, {_ESTADOS}, {_TIPOS}, {_fuentes('pedidos')}
 from @dias d left join @fp p on p.fecha = d.fecha group by {', '.join('d.' + x for x in DIA.split(', '))}""",
    "C02": f"""select {', '.join('d.' + x for x in DIA.split(', '))}, count(id_reserva) as total_reservas,
 {cuantos('estado', reservas_confirmadas='confirmada', reservas_pendientes='pendiente', reservas_canceladas='cancelada')},
 coalesce({pct(n_si("estado = 'confirmada'"), 'count(id_reserva)')}, 0) as tasa_confirmacion_pct, {_fuentes('reservas')}
 from @dias d left join @fr p on p.fecha = d.fecha group by {', '.join('d.' + x for x in DIA.split(', '))}""",
    "C03": f"""select provincia_cliente, provincia_restaurante, anio, mes, trimestre, count(*) as total_pedidos,
 {_INGRESOS} as ingresos_totales, {_TICKET} as ticket_promedio, sum(cantidad_items) as items_vendidos,
 {n_si(_LOCAL)} as pedidos_misma_provincia, {n_si(_EXTERNO)} as pedidos_inter_provincia,
 {pct(n_si(_LOCAL), 'count(*)')} as porcentaje_pedidos_locales, {_ESTADOS}, {_TIPOS}, {_fuentes('pedidos')},
 count(distinct id_usuario) as usuarios_unicos, count(distinct id_restaurante) as restaurantes_unicos
 from @fp group by provincia_cliente, provincia_restaurante, anio, mes, trimestre""",
    "C04": f"""select provincia_restaurante as provincia, anio, mes, trimestre, count(distinct id_restaurante) as restaurantes_activos,
 count(distinct id_repartidor) as repartidores_activos, count(distinct id_usuario) as usuarios_activos,
 count(distinct provincia_cliente) as provincias_origen_clientes, count(*) as total_transacciones, {_INGRESOS} as volumen_negocio,
 {_TICKET} as ticket_promedio_zona, sum(cantidad_items) as items_vendidos, {n_si(_EXTERNO)} as pedidos_recibidos_otras_provincias,
 {pct(n_si(_EXTERNO), 'count(*)')} as porcentaje_clientes_externos, {n_si("estado = 'entregado'")} as pedidos_completados,
 {pct(n_si("estado = 'entregado'"), 'count(*)')} as tasa_completitud_pct, {_fuentes('transacciones')}
 from @fp where provincia_restaurante <> 'Sin Ubicación' group by provincia_restaurante, anio, mes, trimestre""",
    "C05": f"""select provincia_cliente as origen, provincia_restaurante as destino, anio, mes, count(*) as total_pedidos,
 {_INGRESOS} as valor_flujo, {_TICKET} as ticket_promedio, count(distinct id_usuario) as usuarios_unicos,
 count(distinct id_restaurante) as restaurantes_unicos, {_FLUJO} as tipo_flujo, {_fuentes('pedidos')}
 from @fp group by provincia_cliente, provincia_restaurante, anio, mes""",
    "C06": f"""select {', '.join('d.' + x for x in DIA.split(', '))}, count(id_producto) as total_productos_vendidos,
 count(distinct id_producto) as productos_unicos, {_MONTO} as ingresos_productos, coalesce(sum(cantidad), 0) as unidades_vendidas,
 coalesce({_PRECIO}, 0) as precio_promedio,
 {cuantos('nombre_categoria', ventas_bebidas='Bebida', ventas_platos_principales='Plato principal', ventas_postres='Postre', ventas_entradas='Entrada')},
 {cuantos('estado_pedido', productos_entregados='entregado', productos_pendientes='pendiente')}, {_fuentes('productos')}
 from @dias d left join @fd p on p.fecha = d.fecha group by {', '.join('d.' + x for x in DIA.split(', '))}""",
    "C07": f"""select provincia_cliente, provincia_restaurante, nombre_categoria, anio, mes, trimestre, count(*) as total_ventas,
 {_MONTO} as ingresos_categoria, sum(cantidad) as unidades_vendidas, {_PRECIO} as precio_promedio,
 count(distinct id_producto) as productos_unicos, count(distinct id_restaurante) as restaurantes_vendedores,
 count(distinct id_usuario) as usuarios_compradores, {pct(n_si(_LOCAL), 'count(*)')} as porcentaje_ventas_locales, {_fuentes('ventas')}
 from @fd group by provincia_cliente, provincia_restaurante, nombre_categoria, anio, mes, trimestre""",
    "C08": """select id_producto as producto_id, nombre as nombre_producto, nombre_categoria, anio, count(*) as total_ventas,
 cast(sum(subtotal) as double) as ingresos_totales, sum(cantidad) as unidades_vendidas,
 rank() over (partition by anio order by sum(subtotal) desc) as ranking_ingresos
 from @fd group by id_producto, nombre, nombre_categoria, anio""",
    "C09": f"""select id_usuario, id_producto as producto_id, nombre as producto, nombre_categoria, count(*) as veces_comprado,
 sum(cantidad) as unidades_totales, {div('sum(subtotal)', 'count(subtotal)')} as gasto_promedio_por_compra,
 cast(sum(subtotal) as double) as gasto_total_producto, min(strftime(ts, '%Y-%m-%dT%H:%M:%S')) as primera_compra,
 max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) as ultima_compra,
 rank() over (partition by id_usuario order by count(*) desc) as ranking_preferencia_usuario
 from @fd group by id_usuario, id_producto, nombre, nombre_categoria""",
    "C10": f"""select count(distinct fecha) as dias_con_datos, sum(total_pedidos) as pedidos_totales,
 {r('sum(ingresos_totales)')} as ingresos_totales, {r('avg(ticket_promedio)')} as ticket_promedio_general,
 sum(items_vendidos) as items_totales, sum(pedidos_entregados) as pedidos_completados,
 {pct('sum(pedidos_entregados)', 'sum(total_pedidos)')} as tasa_completitud_global from @C01 where total_pedidos > 0""",
    "C11": f"""select provincia, sum(total_transacciones) as transacciones_totales, {r('sum(volumen_negocio)')} as volumen_total,
 sum(restaurantes_activos) as restaurantes_activos, sum(usuarios_activos) as usuarios_activos,
 {r('avg(ticket_promedio_zona)')} as ticket_promedio, {r('avg(tasa_completitud_pct)')} as tasa_completitud_promedio
 from @C04 group by provincia""",
    "C12": f"""select sum(total_reservas) as reservas_totales, sum(reservas_confirmadas) as confirmadas,
 sum(reservas_pendientes) as pendientes, sum(reservas_canceladas) as canceladas,
 {r('avg(tasa_confirmacion_pct)')} as tasa_confirmacion_promedio from @C02 where total_reservas > 0""",
    # --- report ---
    "A01": f"""select nombre_categoria, anio, mes, count(*) as total_ventas, {_MONTO} as ingresos_categoria,
 sum(cantidad) as unidades_vendidas, {_PRECIO} as precio_promedio from @fd group by nombre_categoria, anio, mes""",
    "A02": f"""select anio, nombre as nombre_producto, nombre_categoria, count(*) as total_ventas, {_MONTO} as ingresos_totales,
 sum(cantidad) as unidades_vendidas from @fd group by anio, nombre, nombre_categoria
 order by anio desc, ingresos_totales desc, nombre_producto, nombre_categoria limit 10""",
    "A03": f"""select mes, anio, {_TIPOS}, count(*) as total_pedidos, {pct(n_si("tipo = 'en restaurante'"), 'count(*)')} as pct_restaurante,
 {pct(n_si("tipo = 'para recoger'"), 'count(*)')} as pct_recoger, {_TICKET} as ticket_promedio from @fp group by mes, anio""",
    "A04": f"""select *, {crece('ventas_anuales', 'ventas_ano_anterior')} as crecimiento_ventas_pct from (
 select nombre_categoria, anio, count(*) as ventas_anuales, {_MONTO} as ingresos_anuales,
 lag(count(*)) over (partition by nombre_categoria order by anio) as ventas_ano_anterior from @fd group by nombre_categoria, anio)""",
    "A05": f"""select dia_semana, {etiquetas('dia_semana', NOMBRES_DIA)} as nombre_dia, es_fin_semana, count(*) as pedidos_totales,
 {_INGRESOS} as ingresos_totales, {_TICKET} as ticket_promedio from @fp group by dia_semana, es_fin_semana""",
    "A06": f"""select case when es_fin_semana then 'Fin de Semana' else 'Días Laborables' end as tipo_dia,
 count(distinct fecha) as dias_analizados, count(*) as pedidos_totales, {r(div('count(*)', 'count(distinct fecha)'))} as promedio_pedidos_por_dia,
 {_INGRESOS} as ingresos_totales, {_TICKET} as ticket_promedio, sum(cantidad_items) as items_totales from @fp group by es_fin_semana""",
    "A07": f"""select provincia_restaurante as provincia, case when es_fin_semana then 'Fin de Semana' else 'Laborables' end as tipo_dia,
 count(*) as pedidos_totales, {_INGRESOS} as ingresos_totales, count(distinct fecha) as dias_con_actividad
 from @fp where provincia_restaurante <> 'Sin Ubicación' group by provincia_restaurante, es_fin_semana""",
    "A08": f"""select case when es_fin_semana then 'Fin de Semana' else 'Laborables' end as tipo_dia,
 {cuantos('estado', entregados='entregado', pendientes='pendiente', en_preparacion='en preparacion', listos='listo')}, count(*) as total,
 {pct(n_si("estado = 'entregado'"), 'count(*)')} as tasa_entrega_pct, {pct(n_si("estado = 'pendiente'"), 'count(*)')} as tasa_pendientes_pct
 from @fp group by es_fin_semana""",
    "A09": f"""select *, {crece('pedidos_mes', 'pedidos_mes_anterior')} as crecimiento_pedidos_pct,
 {crece('ingresos_mes', 'ingresos_mes_anterior')} as crecimiento_ingresos_pct from (select *,
 lag(pedidos_mes) over (order by anio, mes) as pedidos_mes_anterior, lag(ingresos_mes) over (order by anio, mes) as ingresos_mes_anterior
 from (select anio, mes, count(*) as pedidos_mes, {_INGRESOS} as ingresos_mes, {_TICKET} as ticket_promedio_mes,
 sum(cantidad_items) as items_mes from @fp group by anio, mes))""",
    "A10": f"""select anio, mes, provincia_restaurante as provincia, count(distinct id_restaurante || '_' || fuente_datos) as restaurantes_activos,
 count(distinct id_usuario || '_' || fuente_datos) as usuarios_activos, count(*) as total_transacciones, {_INGRESOS} as volumen_negocio,
 {_TICKET} as ticket_promedio, {pct(n_si("estado = 'entregado'"), 'count(*)')} as tasa_completitud_pct
 from @fp where provincia_restaurante <> 'Sin Ubicación' group by anio, mes, provincia_restaurante""",
    "A11": f"""select anio, mes, {_FLUJO} as tipo_flujo, count(*) as pedidos_totales, {_INGRESOS} as valor_total, {_TICKET} as ticket_promedio,
 count(distinct id_usuario || '_' || fuente_datos) as usuarios_participantes from @fp group by 1, 2, 3""",
    "A12": f"""select anio, {etiquetas('trimestre', NOMBRES_TRIMESTRE)} as periodo, n as pedidos_trimestre, ingresos as ingresos_trimestre,
 ticket as ticket_promedio_trim, dias_activos, {crece('n', 'n0')} as crecimiento_pedidos_pct, {crece('ingresos', 'i0')} as crecimiento_ingresos_pct
 from (select *, lag(n) over (order by anio, trimestre) as n0, lag(ingresos) over (order by anio, trimestre) as i0 from (
 select anio, trimestre, count(*) as n, {_INGRESOS} as ingresos, {_TICKET} as ticket, count(distinct fecha) as dias_activos
 from @fp group by anio, trimestre))""",
    "A13": f"""select count(distinct fecha) as dias_con_datos, count(*) as pedidos_totales, {_INGRESOS} as ingresos_totales,
 {_TICKET} as ticket_promedio_general, sum(cantidad_items) as items_totales, {n_si("estado = 'entregado'")} as pedidos_completados,
 {pct(n_si("estado = 'entregado'"), 'count(*)')} as tasa_completitud_global from @fp""",
    "A14": f"""select provincia_restaurante as provincia, count(*) as transacciones_totales, {_INGRESOS} as volumen_total,
 count(distinct id_restaurante || '_' || fuente_datos) as restaurantes_activos, count(distinct id_usuario || '_' || fuente_datos) as usuarios_activos,
 {_TICKET} as ticket_promedio, {pct(n_si("estado = 'entregado'"), 'count(*)')} as tasa_completitud_promedio
 from @fp where provincia_restaurante <> 'Sin Ubicación' group by 1""",
    "A15": f"""select count(*) as reservas_totales, {cuantos('estado', confirmadas='confirmada', pendientes='pendiente', canceladas='cancelada')},
 {pct(n_si("estado = 'confirmada'"), 'count(*)')} as tasa_confirmacion_promedio from @fr""",
    # --- dashboard ---
    "D01": "select id_reserva, estado, fuente_datos from @reserva where fuente_datos = 'mongo'",
    "D02": f"""select count(distinct fecha) as dias_activos, count(*) as pedidos_totales, {_INGRESOS} as ingresos_totales,
 {_TICKET2} as ticket_promedio_general, {n_si("estado = 'entregado'")} as pedidos_entregados, sum(cantidad_items) as items_totales from @vp""",
    "D03": f"""select {pct('pedidos_entregados', 'pedidos_totales')} as tasa_entrega_pct,
 {div('pedidos_totales', 'dias_activos')} as pedidos_por_dia from @D02""",
    "D04": _tendencia("fecha"),
    "D05": _tendencia("anio || '-' || lpad(mes::varchar, 2, '0')"),
    "D06": _tendencia("anio || '-Q' || trimestre"),
    "D06_postgres": _tendencia("anio || '-Q' || trimestre", "fuente_datos = 'postgres'"),
    "D07": f"""select count(*) as periodos, sum(pedidos) as total_pedidos, {r('sum(ingresos)')} as total_ingresos,
 {r('avg(ticket_promedio)')} as ticket_promedio, sum(items) as total_items, {_mayor('periodo', 'ingresos')} as mejor_periodo,
 {_menor('periodo', 'ingresos')} as peor_periodo from @D05""",
    "D08": f"""select metrica, {r('avg(valor)')} as promedio, max(valor) as maximo, min(valor) as minimo from (
 select 'pedidos' as metrica, pedidos::double as valor from @D05 union all select 'ingresos', ingresos from @D05
 union all select 'ticket_promedio', ticket_promedio from @D05 union all select 'items', items::double from @D05) group by metrica""",
    "D09": f"""select {r('coalesce(avg((ingresos - antes) / antes * 100), 0)', 4)} as crecimiento_promedio_pct from
 (select ingresos, lag(ingresos) over (order by periodo) as antes from @D05) where antes > 0""",
    "D10": _geo("provincia_restaurante", "ingresos_totales", "clientes_atendidos", "restaurantes_activos", "pct_clientes_externos"),
    "D11": _geo("provincia_cliente", "ingresos_generados", "usuarios_activos", "restaurantes_utilizados", "pct_pedidos_externos"),
    "D12": """select provincia, 'Pedidos Locales' as tipo, total_pedidos::double * (100 - pct_pedidos_externos) / 100 as cantidad from @D11
 union all select provincia, 'Pedidos Externos', total_pedidos::double * pct_pedidos_externos / 100 from @D11""",
    "D13": f"""select provincia_cliente as origen, provincia_restaurante as destino, count(*) as pedidos, {_INGRESOS} as valor_flujo
 from @vp where provincia_cliente <> 'Sin Ubicación' and provincia_restaurante <> 'Sin Ubicación' group by 1, 2""",
    "D14": "select origen, " + ", ".join(
        f"""cast(coalesce(sum(pedidos) filter (where destino = '{p}'), 0) as bigint) as "{p}" """ for p in PROVINCIAS) + " from @D13 group by origen",
    "D15": """select origen || ' → ' || destino as flujo, pedidos, valor_flujo from @D13 order by valor_flujo desc, origen, destino limit 10""",
    "D16": f"""select 'restaurantes' as analisis, count(*) as filas, sum(total_pedidos) as total_pedidos, {r('sum(ingresos_totales)')} as total_valor,
 sum(restaurantes_activos) as restaurantes, sum(clientes_atendidos) as usuarios, {_mayor('provincia', 'ingresos_totales')} as lider,
 {_mayor('provincia', 'pct_clientes_externos')} as mas_externa, max(pct_clientes_externos) as mayor_pct_externos from @D10
 union all select 'clientes', count(*), sum(total_pedidos), {r('sum(ingresos_generados)')}, sum(restaurantes_utilizados), sum(usuarios_activos),
 {_mayor('provincia', 'ingresos_generados')}, {_mayor('provincia', 'pct_pedidos_externos')}, max(pct_pedidos_externos) from @D11
 union all select 'flujos', count(*), sum(pedidos), {r('sum(valor_flujo)')}, null, null, {_mayor("origen || ' → ' || destino", 'valor_flujo')},
 null, null from @D13""",
    "D17": f"""select nombre_categoria, count(*) as ventas_totales, {_MONTO} as ingresos, sum(cantidad) as unidades, {r(_PRECIO)} as precio_promedio,
 count(distinct id_producto) as productos_unicos, {r(div('sum(cantidad)', 'count(cantidad)'))} as cantidad_promedio_por_venta
 from @vd group by nombre_categoria""",
    "D18": f"""select nombre, nombre_categoria, count(*) as ventas_totales, {_MONTO} as ingresos, sum(cantidad) as unidades_vendidas,
 {r(_PRECIO)} as precio_promedio, {r(div('sum(cantidad)', 'count(cantidad)'))} as cantidad_promedio_por_pedido
 from @vd group by nombre, nombre_categoria order by ingresos desc, nombre, nombre_categoria limit 20""",
    "D19": "select * from @D18 order by unidades_vendidas desc, nombre, nombre_categoria limit 15",
    "D20": f"""select nombre_categoria, count(*) as productos, (select {r('avg(ingresos)')} from @D19) as ingresos_promedio,
 (select {r('avg(unidades_vendidas)')} from @D19) as unidades_promedio, (select {r('avg(ventas_totales)')} from @D19) as ventas_promedio
 from @D19 group by nombre_categoria""",
    "D21": f"""select nombre_categoria, min(precio_unitario)::double as precio_minimo, max(precio_unitario)::double as precio_maximo,
 {r(_PRECIO)} as precio_promedio, {r('quantile_cont(precio_unitario::double, 0.5)')} as precio_mediano,
 count(distinct id_producto) as productos_en_categoria, {_MONTO} as ingresos_categoria,
 (max(precio_unitario) - min(precio_unitario))::double as rango_precios from @vd group by nombre_categoria""",
    "D22": f"""select 'categorias' as analisis, count(*) as filas, {r('sum(ingresos)')} as total_ingresos, sum(unidades) as total_unidades,
 sum(productos_unicos) as total_productos, {_mayor('nombre_categoria', 'ingresos')} as lider,
 {_mayor('nombre_categoria', 'productos_unicos')} as mas_productos, {_mayor('nombre_categoria', 'precio_promedio')} as mas_cara,
 {r('avg(precio_promedio)')} as precio_promedio, null as total_ventas, null::double as precio_maximo, null::double as precio_minimo,
 null as mas_barata, null as mayor_rango from @D17
 union all select 'productos', count(*), {r('sum(ingresos)')}, sum(unidades_vendidas), null, {_mayor('nombre', 'ingresos')}, null, null,
 {r('avg(precio_promedio)')}, sum(ventas_totales), null, null, null, null from @D18
 union all select 'precios', count(*), {r('sum(ingresos_categoria)')}, null, null, null, null, {_mayor('nombre_categoria', 'precio_promedio')},
 {r('avg(precio_promedio)')}, null, max(precio_maximo), min(precio_minimo), {_menor('nombre_categoria', 'precio_promedio')},
 {_mayor('nombre_categoria', 'rango_precios')} from @D21""",
    "D23": f"""select dia_semana, {etiquetas('dia_semana', NOMBRES_DIA)} as nombre_dia, es_fin_semana, count(*) as pedidos,
 {_INGRESOS} as ingresos, {_TICKET2} as ticket_promedio from @vp group by dia_semana, es_fin_semana""",
    "D24": f"""select es_fin_semana, sum(pedidos) as pedidos, {r('sum(ingresos)')} as ingresos, {r('avg(ticket_promedio)')} as ticket_promedio,
 case when es_fin_semana then 'Fin de Semana' else 'Días Laborables' end as tipo from @D23 group by es_fin_semana""",
    "D25": f"""select hora, case hora // 6 when 0 then 'Madrugada (0-5)' when 1 then 'Mañana (6-11)' when 2 then 'Tarde (12-17)'
 else 'Noche (18-23)' end as periodo_dia, count(*) as pedidos, {_INGRESOS} as ingresos, {_TICKET2} as ticket_promedio,
 count(distinct id_usuario) as usuarios_activos from @vp group by hora""",
    "D26": f"""select periodo_dia, sum(pedidos) as pedidos, {r('sum(ingresos)')} as ingresos, sum(usuarios_activos) as usuarios_activos
 from @D25 group by periodo_dia""",
    "D27": """select lpad(hora::varchar, 2, '0') || ':00' as hora_formato, pedidos, ingresos, usuarios_activos from @D25
 order by pedidos desc, hora limit 5""",
    "D28": f"""select es_horario_pico, case when es_horario_pico then 'Horario Pico' else 'Horario Normal' end as tipo_horario,
 count(*) as pedidos, {_INGRESOS} as ingresos, {_TICKET2} as ticket_promedio, count(distinct id_usuario) as usuarios_activos,
 count(distinct hora) as horas_diferentes from @vp group by es_horario_pico""",
    "D29": f"""select p.pedidos::double as pedidos_pico, n.pedidos::double as pedidos_normal, (p.pedidos - n.pedidos)::double as diferencia_pedidos,
 p.ingresos as ingresos_pico, n.ingresos as ingresos_normal, {r('p.ingresos - n.ingresos')} as diferencia_ingresos,
 p.ticket_promedio as ticket_promedio_pico, n.ticket_promedio as ticket_promedio_normal,
 {r('p.ticket_promedio - n.ticket_promedio')} as diferencia_ticket_promedio, p.horas_diferentes::double as horas_pico,
 {pct('p.pedidos', 'p.pedidos + n.pedidos')} as participacion_pico_pct
 from (select * from @D28 where es_horario_pico) p, (select * from @D28 where not es_horario_pico) n""",
    "D30": "select hora, es_horario_pico, count(*) as pedidos_en_esta_hora from @vp group by hora, es_horario_pico",
    "D30_lista": """select string_agg(lpad(hora::varchar, 2, '0') || ':00', ', ' order by hora) as horas_pico from @D30 where es_horario_pico""",
    "D31": f"""select 'dias' as analisis, count(*) as filas, sum(pedidos) as total_pedidos, {r('sum(ingresos)')} as total_ingresos,
 {_mayor('nombre_dia', 'pedidos')} as mas_activo, {_menor('nombre_dia', 'pedidos')} as menos_activo,
 {r('avg(ticket_promedio)')} as ticket_promedio, null as usuarios from @D23
 union all select 'horas', count(*), sum(pedidos), {r('sum(ingresos)')}, {_mayor("lpad(hora::varchar, 2, '0') || ':00'", 'pedidos')},
 {_menor("lpad(hora::varchar, 2, '0') || ':00'", 'pedidos')}, null, sum(usuarios_activos) from @D25
 union all select 'pico', count(*), sum(pedidos), {r('sum(ingresos)')}, null, null, {r('avg(ticket_promedio)')}, sum(usuarios_activos) from @D28""",
}
Q["D02_mongo"] = Q["D02"] + " where fuente_datos = 'mongo'"

_TEXTO = """coalesce(string_agg(id_producto || ':' || cantidad || ':' || cast(subtotal as decimal(12,2)), ','
 order by id_producto, cantidad, subtotal), '')"""
_LINEAS = f"select id_pedido, count(*) as lineas, {_TEXTO} as detalle from @detalle group by id_pedido"
_HUECOS = """select id_pedido, id_usuario, case when id_pedido % 13 = 0 or id_pedido % 17 = 0 then null else estado end as estado,
 case when id_pedido % 11 <> 0 then tipo end as tipo, case when id_pedido % 5 <> 0 then (id_pedido % 1000)::double end as total_pedido,
 case when id_pedido % 19 <> 0 then fecha_hora end as fecha_hora from @pedido"""
TABLAS |= {
    "lineas_texto": _LINEAS,
    "huecos": _HUECOS,
    "duenos": "select id_usuario from @usuario where id_usuario % 75 = 30",
    "r_fuera": "select id_restaurante from @restaurante where id_admin in (select id_usuario from @duenos)",
    "m_fuera": "select id_menu from @menu where id_restaurante in (select id_restaurante from @r_fuera)",
    "p_fuera": "select id_producto from @producto where id_menu in (select id_menu from @m_fuera)",
    "pedido_queda": """select * from @pedido where id_usuario not in (select id_usuario from @duenos)
 and (id_restaurante is null or id_restaurante not in (select id_restaurante from @r_fuera))""",
    "reserva_queda": """select * from @reserva where id_usuario not in (select id_usuario from @duenos)
 and id_restaurante not in (select id_restaurante from @r_fuera)""",
    # E27: what is left after the deletions.
    "u2": "select * from @usuario where id_usuario % 20 <> 7",
    "r2": "select * from @restaurante where id_admin in (select id_usuario from @u2)",
    "m2": "select * from @menu where id_menu % 7 <> 3 and id_restaurante in (select id_restaurante from @r2)",
    "pr2": "select * from @producto where id_menu in (select id_menu from @m2)",
    "pe2": """select * from @pedido where id_usuario in (select id_usuario from @u2)
 and id_restaurante in (select id_restaurante from @r2)""",
}


def _seg(expr: str) -> str:
    return f"cast(floor({expr}) as bigint)"


def _iso(ts: str) -> str:
    return f"replace(cast({ts} as varchar), ' ', 'T')"


_PEDIDO_EXT = """id_pedido, id_usuario, id_restaurante, id_repartidor, ts as fecha_hora, estado, tipo,
 cast(total_pedido as double) as total_pedido, cantidad_items, ulat as usuario_latitud, ulng as usuario_longitud,
 rlat as restaurante_latitud, rlng as restaurante_longitud"""
_DETALLE_EXT = """id_pedido, id_producto, cantidad, cast(subtotal as double) as subtotal, cast(precio_unitario as double) as precio_unitario,
 f.nombre as nombre_producto, {cat} as categoria_producto, f.precio as precio_producto, f.id_menu, ts as fecha_hora, id_usuario,
 id_restaurante, id_repartidor, estado_pedido, tipo_pedido, ulat as usuario_latitud, ulng as usuario_longitud,
 rlat as restaurante_latitud, rlng as restaurante_longitud from @fd f join @producto pr using (id_producto)"""
_TIEMPO_ID = "(select m, cast(floor(epoch(ts)) as bigint) as tiempo_id from @minutos) mi"
_EDGES = """select 'Pedido' as origen, id_pedido as id_origen, 'CONTIENE' as tipo, 'Producto' as destino, id_producto as id_destino, source_db from @contiene
 union all select 'Producto', id_producto1, 'COMPRADO_CON', 'Producto', id_producto2, source_db from @cc
 union all select 'Usuario', id_referente, 'REFIERE', 'Usuario', id_referido, source_db from @refiere
 union all select 'Pedido', id_pedido, 'PROVIENE', 'Restaurante', id_restaurante, source_db from @proviene
 union all select 'Pedido', id_pedido, 'PERTENECE', 'Usuario', id_usuario, source_db from @pertenece
 union all select 'Pedido', id_pedido, 'ASIGNADO', 'Repartidor', id_repartidor, source_db from @asignado
 union all select 'Restaurante', id_restaurante, 'DISTANCIA', 'Repartidor', id_repartidor, source_db from @dist
 union all select 'Repartidor', id_repartidor, 'DISTANCIA_ENTREGA', 'Usuario', id_usuario, source_db from @entrega"""


def _merge(tabla: str, clave: str, campo: str) -> str:
    """Last write per node: rewritten nodes end at 20, even ones at 30; new ones come from the changes only."""
    return f"""select * replace (case when {clave} % 6 = 0 then {campo} || '#30' when {clave} % 3 = 0 then {campo} || '#20'
 else {campo} end as {campo}), case when {clave} % 6 = 0 then 30 when {clave} % 3 = 0 then 20 else 10 end as updated_at
 from ({tabla}) where {clave} % 5 <> 0 or {clave} % 3 = 0"""


def _con(nodos: str, aristas: str, clave: str) -> str:
    return f"""select n.*, (select count(*) from {aristas} e where e.{clave} = n.{clave} and e.source_db = n.source_db) as total from {nodos} n"""


Q |= {
    # --- sources ---
    "S01": """select 'usuario' as tabla, count(*) as filas from customer union all select 'restaurante', count(*) from supplier
 union all select 'producto', count(*) from part union all select 'pedido', count(*) from orders union all select 'detalle', count(*) from lineitem
 union all select 'reserva', count(*) from events union all select 'repartidor', count(*) from supplier
 union all select 'menu', count(distinct p_partkey % 40) from part""",
    "S02": """select p.id_pedido, id_usuario, estado, cast(coalesce(lineas, 0) as int) as lineas, coalesce(detalle, '') as detalle
 from @pedido p left join @lineas_texto l on l.id_pedido = p.id_pedido where fuente_datos = 'mongo'""",
    "S03": "select id_usuario, nombre, latitud, longitud, id_referido from @usuario",
    "S04": """select s_name as nombre, case s_suppkey % 3 when 0 then 'N' || s_nationkey when 1 then 'N' || s_nationkey || ', Costa Rica'
 else 'San José, Costa Rica' end as direccion, 9.0::double + s_suppkey::double / 1000.0::double as latitud,
 -84.0::double - s_suppkey::double / 1000.0::double as longitud from supplier
 where s_suppkey % 7 <> 3 and s_suppkey % 5 <> 4 and s_suppkey % 11 <> 5""",
    "S05": f"select anio, count(*) as pedidos, {_INGRESOS} as ingresos from @fp group by anio",
    "S06": """select 'dim_tiempo' as tabla, count(*) as filas from @minutos union all select 'dim_ubicacion', 8
 union all select 'dim_categorias', count(*) from @categorias
 union all select 'dim_productos', count(distinct id_producto || fuente_datos) from @fd union all select 'fact_pedidos', count(*) from @fp
 union all select 'fact_reservas', count(*) from @fr union all select 'fact_detalle_pedidos', count(*) from @fd""",
    "S07": "select v.*, (select count(*) from @fp f where f.provincia_cliente = v.provincia) as pedidos from (values "
           + ", ".join(
               "({}, '{}', {}, {}, {}, {}, {})".format(
                   u[0], u[1], *[f"{x}::double" if x else "null::double" for x in u[2:6]], str(u[6]).lower()) for u in UBICACIONES)
           + ") v(ubicacion_id, provincia, latitud_min, latitud_max, longitud_min, longitud_max, es_zona_activa)",
    "S08": f"select anio, mes, count(*) as filas, {_INGRESOS} as ingresos from @fp group by anio, mes",
    "S09": Q["D25"],
    # --- ETL ---
    "E01": f"select {_PEDIDO_EXT} from @fp where fuente_datos = 'postgres'",
    "E02": f"select {_PEDIDO_EXT} from @fp where fuente_datos = 'mongo'",
    "E03": "select id_reserva, id_usuario, id_restaurante, fecha_hora, estado from @reserva where fuente_datos = 'postgres'",
    "E04": "select id_reserva, id_usuario, id_restaurante, fecha_hora, estado from @reserva where fuente_datos = 'mongo'",
    "E05": f"select {_DETALLE_EXT.format(cat='''coalesce(nullif(pr.categoria, ''), 'Sin categoría')''')} where fuente_datos = 'postgres'",
    "E06": f"select {_DETALLE_EXT.format(cat='pr.categoria')} where fuente_datos = 'mongo'",
    "E07": """select id_pedido, id_usuario, coalesce(estado, 'unknown') as estado, coalesce(tipo, 'unknown') as tipo,
 coalesce(total_pedido, 0) as total_pedido from @huecos""",
    "E08": "select id_pedido, fecha_hora from @huecos where fecha_hora is not null",
    "E09": "select event_id as id_reserva, case when event_id % 10 <> 3 then ts end as fecha_hora from events",
    "E10": "select fuente_datos, estado, count(*) as filas, min(fecha_hora) as primera from @reserva group by 1, 2",
    "E11": f"""select {_seg('epoch(ts)')} as tiempo_id, fecha, hora, cast(minute(ts) as int) as minuto, anio, mes, cast(day(ts) as int) as dia,
 trimestre, dia_semana, es_fin_semana, es_horario_pico from (select ts, {ATRIBUTOS} from @minutos)""",
    "E12": """select id_reserva, cast(floor(epoch(coalesce(
 min(fecha_hora) filter (where id_reserva % 2 = 1) over w, min(fecha_hora) over w))) as bigint) as tiempo_id
 from @reserva window w as (partition by date_trunc('minute', fecha_hora))""",
    "E13": f"select id_usuario, {prov('latitud', 'longitud')} as provincia from @usuario",
    "E14": "select id_usuario, case " + " ".join(
        f"when latitud between {u[2]} and {u[3]} and longitud between {u[4]} and {u[5]} then '{u[1]}'" for u in UBICACIONES if u[2])
        + " else 'Sin Ubicación' end as provincia from @usuario",
    "E15": """select cast(case nombre_categoria when 'Postre' then 40 when 'Entrada' then 7
 else 40 + row_number() over (partition by nombre_categoria in ('Postre', 'Entrada') order by nombre_categoria) end as int) as categoria_id,
 nombre_categoria from @categorias""",
    "E16": """select distinct f.id_producto as producto_id, f.nombre, cast(c.categoria_id as int) as categoria_id, f.precio as precio_actual,
 f.id_menu, true as activo, f.fuente_datos from @fd f join @categorias c using (nombre_categoria)""",
    "E17_incremento": "select id_pedido + 1000000000 as id_pedido, fuente_datos from @pedido where id_pedido % 97 = 0",
    "E17": "select id_pedido, fuente_datos from @pedido where id_pedido % 4 = 0 and fuente_datos = 'postgres'",
    "E18": f"""select id_pedido, tiempo_id, id_usuario, id_restaurante, id_repartidor, estado, tipo, total_pedido::double as total_pedido,
 cast(cantidad_items as int) as cantidad_items, {r('ulat', 8)} as usuario_latitud, {r('ulng', 8)} as usuario_longitud,
 {r('rlat', 8)} as restaurante_latitud, {r('rlng', 8)} as restaurante_longitud, provincia_cliente, provincia_restaurante, {_iso('f.ts')} as fecha_creacion, fuente_datos, anio, mes
 from @fp f join {_TIEMPO_ID} on mi.m = date_trunc('minute', f.ts)""",
    "E19": f"""select id_reserva, tiempo_id, id_usuario, id_restaurante, estado, {_iso('f.ts')} as fecha_creacion, fuente_datos, anio, mes
 from @fr f join {_TIEMPO_ID} on mi.m = date_trunc('minute', f.ts)""",
    "E20": f"""select id_pedido, id_producto, tiempo_id, cast(c.categoria_id as int) as categoria_id, id_usuario, id_restaurante, id_repartidor,
 estado_pedido, tipo_pedido, cantidad, precio_unitario::double as precio_unitario, subtotal::double as subtotal, provincia_cliente,
 provincia_restaurante, {_iso('f.ts')} as fecha_creacion, fuente_datos, anio, mes
 from @fd f join {_TIEMPO_ID} on mi.m = date_trunc('minute', f.ts) join @categorias c using (nombre_categoria)""",
    "E21": """select tabla, filas as primera, 0::bigint as segunda, filas from @S06 where tabla <> 'dim_ubicacion'""",
    "E22": f"""select id_pedido, id_detalle, case when id_pedido % 10 = 0 then d.id_producto + 100000000 else d.id_producto end as id_producto,
 case when id_pedido % 7 = 0 then 0 else cantidad end as cantidad,
 case when id_pedido % 7 <> 0 and id_pedido % 10 <> 0 then {r('precio * cantidad')} end as subtotal,
 case when id_pedido % 7 = 0 then 'Producto inválido o cantidad incorrecta' when id_pedido % 10 = 0 then 'Producto no encontrado' end as motivo_rechazo
 from @detalle d join @producto p on p.id_producto = d.id_producto""",
    "E23": """select p.id_pedido, estado, cast(coalesce(lineas, 0) as int) as lineas, coalesce(detalle, '') as detalle
 from @pedido p left join @lineas_texto l on l.id_pedido = p.id_pedido""",
    "E24": """select id_pedido, id_usuario, id_restaurante,
 case when estado <> 'entregado' and id_repartidor is null then 1 else id_repartidor end as id_repartidor, fecha_hora,
 case when id_pedido % 2 = 0 then 'entregado' else estado end as estado,
 case when estado <> 'entregado' and id_pedido % 3 = 0 then 'para recoger' else tipo end as tipo, fuente_datos from @pedido""",
    "E24_almacen": f"""select p.id_pedido, fuente_datos, case when p.id_pedido % 13 = 5 and p.id_pedido % 2 = 0 then 'entregado' else estado end as estado,
 case when p.id_pedido % 13 = 5 and p.id_pedido % 3 = 0 then 'para recoger' else tipo end as tipo,
 case when p.id_pedido % 13 = 5 then coalesce(id_repartidor, 1) else id_repartidor end as id_repartidor, total_pedido::double as total_pedido,
 provincia_cliente, {_iso('f.ts')} as fecha_creacion, cast(year(f.ts) as int) as anio, cast(month(f.ts) as int) as mes,
 strftime(f.ts, '%Y-%m-%d') as fecha, cast(hour(f.ts) as int) as hora, cast(minute(f.ts) as int) as minuto,
 coalesce(n, 0) as lineas, coalesce(n, 0) as acordes
 from @fp p join (select id_pedido, case when id_pedido % 13 = 5 and id_pedido % 4 = 1 then ts + interval 40 days + interval 17 minutes
 else ts end as ts from @fp) f on f.id_pedido = p.id_pedido
 left join (select id_pedido, count(*) as n from @fd group by 1) l on l.id_pedido = p.id_pedido""",
    "E25": """select id_repartidor, nombre, telefono, vehiculo, case when id_repartidor % 2 = 0 then 9.93::double else latitud_actual end as latitud_actual,
 case when id_repartidor % 2 = 0 then -84.08::double else longitud_actual end as longitud_actual,
 case when id_repartidor % 4 <> 1 and id_repartidor % 3 = 0 then 'desconectado' else estado end as estado from @repartidor""",
    "E26": """select 'reserva' as entidad, (select count(*) from @reserva) - (select count(*) from @reserva_queda) as eliminados
 union all select 'pedido', (select count(*) from @pedido) - (select count(*) from @pedido_queda)
 union all select 'restaurante', count(*) from @r_fuera union all select 'menu', count(*) from @m_fuera
 union all select 'producto', count(*) from @p_fuera""",
    "E26_pedidos": f"""select p.id_pedido, cast(coalesce(lineas, 0) as int) as lineas, coalesce(detalle, '') as detalle from @pedido_queda p left join
 (select id_pedido, count(*) as lineas, {_TEXTO} as detalle from @detalle where id_producto not in (select id_producto from @p_fuera)
 group by id_pedido) l on l.id_pedido = p.id_pedido""",
    "E27": """select 'usuario' as tabla, count(*) as filas, count(*) filter (where id_referido is null or id_referido % 20 = 7) as nulos from @u2
 union all select 'restaurante', count(*), 0 from @r2 union all select 'menu', count(*), 0 from @m2
 union all select 'producto', count(*), 0 from @pr2
 union all select 'reserva', count(*), 0 from @reserva where id_usuario in (select id_usuario from @u2)
 and id_restaurante in (select id_restaurante from @r2)
 union all select 'pedido', count(*), count(*) filter (where id_repartidor is null or id_repartidor % 9 = 2) from @pe2
 union all select 'detalle', count(*), 0 from @detalle where id_pedido in (select id_pedido from @pe2)
 and id_producto in (select id_producto from @pr2)""",
    "E28": """select 'usuario' as entidad, 'rol_invalido' as regla, 0 as filas union all select 'usuario', 'coordenadas_fuera_de_rango', 0
 union all select 'usuario', 'email_repetido', count(*) from (select count(*) over (partition by email) as n from @usuario) where n > 1
 union all select 'restaurante', 'coordenadas_fuera_de_rango', count(*) from @restaurante where id_restaurante % 8 = 1
 union all select 'repartidor', 'estado_invalido', count(*) from @repartidor where id_repartidor % 6 = 5
 union all select 'repartidor', 'coordenadas_fuera_de_rango', 0
 union all select 'producto', 'precio_negativo', count(*) from @producto where id_producto % 50 = 9
 union all select 'reserva', 'estado_invalido', 0 union all select 'pedido', 'estado_invalido', 0
 union all select 'pedido', 'tipo_invalido', count(*) from @pedido where id_pedido % 31 = 0
 union all select 'detalle', 'cantidad_no_positiva', count(*) from @detalle where id_pedido % 29 = 0
 union all select 'detalle', 'subtotal_negativo', 0""",
    # --- graph ---
    "G01": _merge("select * from @nr", "id_restaurante", "nombre"),
    "G02": _merge("select * exclude (estado) from @nd", "id_repartidor", "nombre"),
    "G03": _merge("select * from @nu", "id_usuario", "nombre"),
    "G04": _merge("select * from @npe", "id_pedido", "estado"),
    "G05": _merge("select * from @np", "id_producto", "nombre"),
    "G06": "select * from @contiene",
    "G07": "select * from @proviene",
    "G08": "select * from @pertenece",
    "G09": "select * from @asignado",
    "G10": "select * from @refiere",
    "G11": "select * from @cc",
    "G12": f"""select a.n1 as producto1, a.n2 as producto2, a.frecuencia, {r('a.support', 4)} as support, {r('a.confidence', 4)} as confidence_p1_to_p2,
 {r('b.confidence', 4)} as confidence_p2_to_p1 from @ccn a join @cc b on b.id_producto1 = a.id_producto2 and b.id_producto2 = a.id_producto1
 and a.source_db = b.source_db where a.id_producto1 < a.id_producto2 and a.source_db = 'postgres'
 order by a.frecuencia desc, a.support desc, a.id_producto1, a.id_producto2 limit 5""",
    "G13": """select id_usuario, nombre, total_referidos from @refs where source_db = 'postgres' order by total_referidos desc, id_usuario limit 5""",
    "G14": f"""select source_db, id_restaurante, id_repartidor, repartidor as nombre, latitud, longitud, {r('distancia_km')} as distancia_km
 from @dist where puesto = 1""",
    "G15": f"select * replace ({r('distancia_km', 4)} as distancia_km) from @entrega",
    "G16": f"""select a.source_db, a.id_repartidor, a.id_usuario as desde, b.id_usuario as hasta,
 {r(km('a.latitud', 'a.longitud', 'b.latitud', 'b.longitud'), 4)} as distancia_km from @paradas a join @paradas b
 on a.source_db = b.source_db and a.id_repartidor = b.id_repartidor and a.id_usuario <> b.id_usuario""",
    "G18": f"""select p.fuente_datos as source_db, p.id_pedido, p.id_restaurante, d.id_repartidor, d.repartidor as nombre, {r('d.distancia_km')} as distancia_km,
 case when d.id_repartidor is null then 'pendiente' else 'en preparacion' end as estado,
 case when p.id_restaurante is null then 'Restaurante no tiene ubicación configurada'
 when d.id_repartidor is null then 'No hay repartidores disponibles con ubicación' end as motivo
 from @pedido p left join (select * from @dist where puesto = 1) d on d.id_restaurante = p.id_restaurante and d.source_db = p.fuente_datos
 where p.estado = 'pendiente'""",
    "G19": """select source_db, (select count(*) from @producto) as productos_sincronizados,
 (select count(*) from @pedido p where p.fuente_datos = source_db) as pedidos_sincronizados,
 (select count(*) from @detalle d where d.fuente_datos = source_db) as relaciones_creadas from (values ('postgres'), ('mongo')) f(source_db)""",
    "G20": """select n1 as producto1, n2 as producto2, c1 as categoria1, c2 as categoria2, source_db as fuente_datos, frecuencia, support,
 confidence as confidence_p1_to_p2, n1 || ' + ' || n2 as par_productos from @ccn where id_producto1 < id_producto2
 order by frecuencia desc, support desc, id_producto1, id_producto2, source_db limit 20""",
    "G21": f"""select (select count(*) from @np) as total_productos, count(*) as total_relaciones_copurchase,
 count(distinct id_producto1 || source_db) as productos_con_copurchases, {r('avg(frecuencia)', 6)} as frecuencia_promedio,
 max(frecuencia) as frecuencia_maxima, {r('avg(support)', 8)} as support_promedio, max(support) as support_maximo from @cc""",
    "G22": """select n1 as producto_origen, n2 as producto_destino, c1 as categoria_origen, c2 as categoria_destino, source_db as fuente_datos,
 frecuencia, support, confidence, case when confidence >= 0.7 then 'Muy Alta' when confidence >= 0.5 then 'Alta'
 when confidence >= 0.3 then 'Media' else 'Baja' end as fuerza_relacion from @ccn where confidence >= 0.3
 order by confidence desc, frecuencia desc, id_producto1, id_producto2, source_db limit 15""",
    "G23": """select n1 as producto_base, n2 as producto_recomendado, c2 as categoria_recomendado, source_db as fuente_datos, frecuencia, support,
 confidence, case when confidence >= 0.7 then 'Muy recomendado' when confidence >= 0.5 then 'Recomendado'
 when confidence >= 0.3 then 'Moderadamente recomendado' else 'Débilmente recomendado' end as nivel_recomendacion
 from @ccn where contains(n1, 'gear') order by confidence desc, frecuencia desc, id_producto1, id_producto2, source_db limit 15""",
    "G24": f"""select first(producto_recomendado order by confidence desc, frecuencia desc, producto_recomendado) as mejor_recomendacion,
 max(confidence) as mejor_confidence, {r('avg(confidence)', 6)} as confidence_promedio, count(*) as total_recomendaciones,
 (select categoria_recomendado from @G23 group by 1 order by count(*) desc, 1 limit 1) as categoria_mas_recomendada from @G23""",
    "G24_lista": """select distinct unnest([n1, n2]) as producto from (select n1, n2 from @ccn where id_producto1 < id_producto2
 order by frecuencia desc, support desc, id_producto1, id_producto2, source_db limit 100)""",
    "G25": f"select {pct('productos_con_copurchases', 'total_productos')} as cobertura_pct from @G21",
    "G26": "select id_usuario, nombre, source_db as fuente_datos, total_referidos, nivel_influencia from @niveles",
    "G27": f"""select count(*) as total_usuarios, {n_si('total_referidos > 0')} as usuarios_con_referidos,
 {div('sum(total_referidos)', 'count(*)')} as promedio_referidos_por_usuario, max(total_referidos) as max_referidos,
 sum(total_referidos) as total_referencias from @refs""",
    "G28_postgres": f"""select nivel_influencia, count(*) as cantidad_usuarios,
 {pct('count(*)', '(select count(*) from @usuario)')} as porcentaje from @niveles where source_db = 'postgres' group by 1""",
    "G28": f"""select nivel_influencia, count(*) as cantidad_usuarios,
 {pct('count(*)', '(select count(*) from @niveles)')} as porcentaje from @niveles group by 1""",
    "G29": f"select {pct('usuarios_con_referidos', 'total_usuarios')} as tasa_engagement_pct from @G27",
    "G30": f"""select id_repartidor, nombre as nombre_repartidor, source_db as fuente_datos, latitud_actual as latitud, longitud_actual as longitud,
 total as total_pedidos_asignados from ({_con('@nd', '@asignado', 'id_repartidor')})
 order by total desc, nombre, id_repartidor, source_db limit 20""",
    "G31": f"""select first(nombre_repartidor order by total_pedidos_asignados desc, nombre_repartidor) as lider,
 max(total_pedidos_asignados) as pedidos_lider, {r('avg(total_pedidos_asignados) filter (where total_pedidos_asignados > 0)', 4)} as promedio_activos,
 {n_si('total_pedidos_asignados > 0')} as activos, {pct(n_si('total_pedidos_asignados > 0'), 'count(*)')} as actividad_pct from @conductores""",
    "G32": f"""select id_restaurante, nombre as nombre_restaurante, source_db as fuente_datos, latitud, longitud, total as total_pedidos_recibidos
 from ({_con('@nr', '@proviene', 'id_restaurante')}) order by total desc, nombre, id_restaurante, source_db limit 20""",
    "G33": f"""select id_restaurante, nombre_restaurante, fuente_datos, total_pedidos_recibidos,
 {pct('total_pedidos_recibidos', 'sum(total_pedidos_recibidos) over ()')} as porcentaje from (select * from @G32 where total_pedidos_recibidos > 0
 order by total_pedidos_recibidos desc, nombre_restaurante, id_restaurante, fuente_datos limit 10)""",
    "G34": """select (select count(*) from @nd) as total_repartidores, (select count(*) from @nr) as total_restaurantes,
 (select count(*) from @nu) as total_usuarios, (select count(*) from @npe) as total_pedidos,
 (select count(*) from @asignado) as pedidos_asignados, (select count(*) from @proviene) as pedidos_con_restaurante""",
    "G35": f"""select {pct('pedidos_asignados', 'total_pedidos')} as tasa_asignacion_pct, {pct('pedidos_con_restaurante', 'total_pedidos')} as tasa_restaurante_pct,
 {r(div('pedidos_asignados', 'total_repartidores'))} as pedidos_por_repartidor from @G34""",
    "eficiencia": f"""select d.id_repartidor, d.nombre as nombre_repartidor, d.source_db as fuente_datos, d.total as pedidos_asignados,
 coalesce(e.n, 0) as usuarios_en_rango, coalesce(e.media, 0) as distancia_promedio_km, coalesce(e.minima, 0) as distancia_minima_km,
 coalesce(e.maxima, 0) as distancia_maxima_km,
 coalesce(case when d.total > 0 then {r('d.total::double / e.media')} end, 0) as eficiencia_pedidos_por_km
 from ({_con('@nd', '@asignado', 'id_repartidor')}) d left join (select source_db, id_repartidor, count(distinct id_usuario) as n,
 avg(distancia_km) as media, min(distancia_km) as minima, max(distancia_km) as maxima from @entrega group by 1, 2) e
 on e.id_repartidor = d.id_repartidor and e.source_db = d.source_db where d.total > 0 or e.n > 0""",
    "G36": f"""select * replace ({', '.join(f"{r(f'distancia_{x}_km', 4)} as distancia_{x}_km" for x in ('promedio', 'minima', 'maxima'))}) from @eficiencia""",
    "G37": f"""select id_repartidor, nombre_repartidor, fuente_datos, pedidos_asignados, eficiencia_pedidos_por_km,
 (select {r('avg(eficiencia_pedidos_por_km)', 4)} from @eficiencia) as eficiencia_promedio,
 (select {r('avg(distancia_promedio_km)', 4)} from @eficiencia) as distancia_promedio, (select count(*) from @eficiencia) as analizados
 from @eficiencia where eficiencia_pedidos_por_km > 0
 order by eficiencia_pedidos_por_km desc, pedidos_asignados desc, id_repartidor, fuente_datos limit 10""",
    "G38": f"""select n1 as producto1, n2 as producto2, c1 as categoria1, c2 as categoria2, {r('avg(precio1 + precio2)', 4)} as precio_promedio_combo
 from @ccn where id_producto1 < id_producto2 group by 1, 2, 3, 4 order by precio_promedio_combo desc, 1, 2, 3, 4 limit 5""",
    "G39": f"""select nombre as usuario_influyente, id_usuario, total_referidos, {r('latitud', 1)} as zona_lat, {r('longitud', 1)} as zona_lng,
 printf('%.2f,%.2f', latitud, longitud) as ubicacion from @refs where source_db = 'postgres' and total_referidos >= 1
 order by total_referidos desc, zona_lat, zona_lng, id_usuario limit 10""",
    "G40": f"""select source_db, id_restaurante, restaurante, id_repartidor, repartidor, latitud as repartidor_lat, longitud as repartidor_lng,
 {r('distancia_km', 4)} as distancia_km from @dist""",
    "G40_k10": f"""select source_db, id_restaurante, restaurante, id_repartidor, repartidor, latitud as repartidor_lat, longitud as repartidor_lng,
 {r('distancia_km', 4)} as distancia_km from @dist10""",
    "G41": """select id_restaurante, id_pedido, id_repartidor, id_usuario, source_db from @proviene
 join @asignado using (id_pedido, source_db) join @pertenece using (id_pedido, source_db)""",
    "G42": "select * from @cc where frecuencia >= 2",
    "G43": """select r.id_referente, a.nombre as referente, r.id_referido, b.nombre as referido, r.source_db from @refiere r
 join @usuario a on a.id_usuario = r.id_referente join @usuario b on b.id_usuario = r.id_referido""",
    "G44": """select n.id_restaurante, n.source_db, p.id_pedido, c.id_producto, c.cantidad, u.id_usuario, a.id_repartidor from @nr n
 left join @proviene p on p.id_restaurante = n.id_restaurante and p.source_db = n.source_db
 left join @contiene c on c.id_pedido = p.id_pedido left join @pertenece u on u.id_pedido = p.id_pedido
 left join @asignado a on a.id_pedido = p.id_pedido""",
    "G45": _EDGES,
    "G46": """select 'Usuario' as label, count(*) as total from @nu union all select 'Producto', count(*) from @np
 union all select 'Pedido', count(*) from @npe union all select 'Restaurante', count(*) from @nr
 union all select 'Repartidor', count(*) from @nd""",
    # --- search and operational reads ---
    "T01": "select * from @indice",
    "T01_tokens": "select id_producto, campo, token, tf, cast(largo as int) as largo from @tf",
    "T02": f"""select id_producto, {r('max(s)', 6)} as score from (select id_producto, campo,
 sum(s) * case campo when 'nombre' then 3.0 when 'categoria' then 2.0 else 1.0 end as s from (
 select t.id_producto, t.campo, q.palabra, max((1.0::double - q.errores::double / length(q.palabra)::double)
 * ln(1 + ((select count(*) from @indice) - q.df + 0.5::double) / (q.df + 0.5::double))
 * (t.tf * 2.2::double / (t.tf + 1.2::double * (0.25::double + 0.75::double * t.largo / l.medio)))) as s
 from @tf t join (select * from (select v.campo, v.token, v.df, p.palabra, damerau_levenshtein(v.token, p.palabra) as errores
  from (select campo, token, count(*)::double as df from @tf group by 1, 2) v, (values {{palabras}}) p(palabra))
  where errores <= case when length(palabra) <= 2 then 0 when length(palabra) <= 5 then 1 else 2 end) q
 on q.campo = t.campo and q.token = t.token
 join (select campo, avg(largo)::double as medio from (select distinct id_producto, campo, largo from @tf) group by 1) l on l.campo = t.campo
 group by 1, 2, 3) group by 1, 2) group by 1""",
    "T03": """select *, (select count(*) from @indice where categoria = 'Postre') as total from @indice where categoria = 'Postre'
 order by id_producto limit 20""",
    "T04": """select id_usuario, nombre, (select count(*) from customer) as total from @usuario order by nombre, id_usuario limit 25 offset 50""",
    "T04_ultima": """select id_usuario, nombre, (select count(*) from customer) as total from @usuario order by nombre, id_usuario limit 25 offset 125""",
    "T04_categoria": """select *, (select count(*) from @indice where categoria = 'Postre') as total from @indice where categoria = 'Postre'
 order by id_producto limit 5 offset 5""",
    "T05": """select id_producto, nombre, categoria, descripcion, precio, id_menu from @indice where id_producto % 4 <> 0
 and (id_producto % 6 <> 1 or id_producto % 12 = 1)
 union all select case when id_producto % 12 = 1 then id_producto + 50000000 else id_producto end, nombre || ' v2', categoria,
 'Producto sin descripción', precio, id_menu from @indice where (id_producto % 4 = 0 or id_producto % 6 = 1) and id_producto % 8 <> 0""",
    "O01": """select id_repartidor, p.id_pedido, fecha_hora, estado, coalesce(detalle, '') as detalle from @pedido p
 left join @lineas_texto l on l.id_pedido = p.id_pedido where estado <> 'entregado' and id_repartidor is not null""",
    "O02": "select * from @pedido where id_repartidor is null and estado = 'pendiente'",
    "O03": "select * from @repartidor where estado = 'disponible'",
    "O04": "select * from @repartidor where estado = 'disponible' and latitud_actual is not null and longitud_actual is not null",
    "O05": """select distinct u.* exclude (fecha_registro), p.id_repartidor from @pedido p join @usuario u on u.id_usuario = p.id_usuario
 where p.estado <> 'entregado' and p.id_repartidor is not null""",
    "O06": "select * from @usuario where latitud is not null and longitud is not null",
    "O07": "select * from @usuario where id_referido is not null",
    "O08": "select * from @restaurante",
    "O09": "select * from @usuario",
    "O09_reservas": "select * from @reserva",
}

_CUBOS = ("cubo_pedidos_tiempo", "cubo_reservas_tiempo", "cubo_pedidos_ubicacion", "cubo_actividad_zona", "cubo_matriz_od",
          "cubo_productos_tiempo", "cubo_productos_ubicacion", "cubo_top_productos_anual", "cubo_frecuencia_uso")
Q["S06_cubos"] = " union all ".join(f"select '{n}' as tabla, count(*) as filas from @C0{i}" for i, n in enumerate(_CUBOS, 1))
Q["G16_cercanas"] = f"""select * replace ({r('distancia_km', 4)} as distancia_km) from (
 select a.source_db, a.id_repartidor, a.id_usuario as desde, b.id_usuario as hasta, {km('a.latitud', 'a.longitud', 'b.latitud', 'b.longitud')} as distancia_km,
 cast(row_number() over (partition by a.source_db, a.id_repartidor, a.id_usuario
  order by {km('a.latitud', 'a.longitud', 'b.latitud', 'b.longitud')}, b.id_usuario) as int) as puesto
 from @paradas a join @paradas b on a.source_db = b.source_db and a.id_repartidor = b.id_repartidor and a.id_usuario <> b.id_usuario)
 where puesto <= 3"""
# Greedy routes, one step of every driver per round.
TABLAS["ruta"] = f"""select distinct source_db, id_repartidor, 0 as orden, latitud_actual as lat, longitud_actual as lng, 0.0::double as total,
 []::bigint[] as vistos, null::bigint as id_usuario, null::varchar as nombre, null::double as tramo from @paradas
 union all select source_db, id_repartidor, orden + 1, latitud, longitud,
 total + case when orden = 0 then {r('d')} else d end, list_append(vistos, sig), sig, sig_nombre, {r('d')}
 from (select *, row_number() over (partition by source_db, id_repartidor order by round(d, 9), sig) as rn from (
  select w.source_db, w.id_repartidor, w.orden, w.total, w.vistos, s.id_usuario as sig, s.nombre as sig_nombre, s.latitud, s.longitud,
  {km('w.lat', 'w.lng', 's.latitud', 's.longitud')} as d from t_ruta w join @paradas s on s.source_db = w.source_db
  and s.id_repartidor = w.id_repartidor and not list_contains(w.vistos, s.id_usuario))) where rn = 1"""
Q["G17"] = f"""select source_db, id_repartidor, orden, id_usuario, nombre, tramo as distancia_tramo, {r('total')} as distancia_acumulada,
 count(*) over w as total_paradas, max({r('total')}) over w as distancia_total from @ruta where orden > 0
 window w as (partition by source_db, id_repartidor)"""


def _palabras(*palabras: str) -> str:
    return ", ".join(f"('{p}')" for p in palabras)


TABLAS["conductores"] = f"""select id_repartidor, nombre as nombre_repartidor, total as total_pedidos_asignados
 from ({_con('@nd', '@asignado', 'id_repartidor')})"""

_T02 = Q["T02"]
Q["T02"] = _T02.replace("{palabras}", _palabras("smal", "wigdet", "brand", "2"))
Q["T02_indice"] = Q["T02"]
# The same search over the changed products.
TABLAS["palabras_cambiadas"] = TABLAS["palabras"].replace("@indice", "@T05")
TABLAS["tf_cambiados"] = TABLAS["tf"].replace("@palabras", "@palabras_cambiadas")
Q["T05_busqueda"] = _T02.replace("{palabras}", _palabras("smal", "wigdet", "v2", "brand", "2")).replace("@tf", "@tf_cambiados").replace("@indice", "@T05")
Q["T05_productos"] = "select * from @T05"
TABLAS["puntos"] = _T02.replace("{palabras}", _palabras("smal", "wigdet"))
Q["T02_pagina"] = """select i.*, s.score, (select count(*) from @puntos) as total from @indice i join @puntos s using (id_producto)
 order by score desc, id_producto limit 10 offset 10"""
Q["T02_listado"] = Q["T02_pagina"]

# DuckDB sums integers into 128 bits; these results are 64-bit columns.
_SUMA_ENTERA = re.compile(
    r"\bsum\((cantidad|cantidad_items|items_vendidos|items|pedidos|pedidos_entregados|total_pedidos|total_reservas|"
    r"reservas_confirmadas|reservas_pendientes|reservas_canceladas|total_transacciones|restaurantes_activos|usuarios_activos|"
    r"restaurantes_utilizados|clientes_atendidos|unidades|unidades_vendidas|productos_unicos|ventas_totales|total_referidos)\)"
    r"(?!\s*(filter|over))"
)
_REF = re.compile(r"(?<!')@(\w+)")


def _sql(nombre: str) -> str:
    """A query with the common tables it refers to, each after those it needs itself."""
    fuentes = {**TABLAS, **{k: v for k, v in Q.items()}}
    orden: list[str] = []

    def visit(texto: str) -> None:
        for ref in dict.fromkeys(_REF.findall(texto)):
            if ref not in orden:
                visit(fuentes[ref])
                orden.append(ref)

    visit(Q[nombre])
    ctes = ",\n".join(f"t_{ref} as ({_REF.sub(r't_\1', fuentes[ref])})" for ref in orden)
    texto = (f"with recursive {ctes}\n" if ctes else "") + _REF.sub(r"t_\1", Q[nombre])
    return _SUMA_ENTERA.sub(r"cast(sum(\1) as bigint)", texto)


def oracle_sql() -> dict[str, str]:
    return {nombre: _sql(nombre) for nombre in Q if nombre != "eficiencia"}

