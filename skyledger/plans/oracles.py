"""Reference SQL for the registered queries, in DuckDB's dialect.

Written from the definitions, over the supplied tables only.
"""

from __future__ import annotations

from collections.abc import Callable

# The domains of the flights, as in the generators.
_CLASSES = "['Económica', 'Negocios', 'Primera']"
_AIRPORTS = "['SCL', 'MIA', 'JFK', 'MAD', 'BUE', 'LIM', 'FRA', 'CDG']"
_AIRLINES = "['AirCorp', 'AeroSky', 'GlobalAir', 'FlyFast']"
_PLANES = "['B787', 'A320', 'B737', 'A380']"
_SEATS = "[300, 180, 210, 550]"



def _half_up(value: str, digits: int) -> str:
    """Round a double half up on its decimal text. DuckDB's own ``round`` scales
    the binary value first, which turns 20.365 into 20.36."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


_MILES = _half_up("CAST(op_distancia_km AS DOUBLE) * CAST(0.621371 AS DOUBLE)", 2)
_LOAD_PERCENT = _half_up(
    "(coalesce(CAST(gld_pasajeros_totales AS DOUBLE) / nullif(gld_capacidad_total, 0), 0) * 100)", 2
)
_PER_PASSENGER = _half_up("coalesce(gld_ingreso_total / nullif(gld_pasajeros_totales, 0), 0)", 2)
_MEAN_LOAD = _half_up(
    "avg(CAST(op_pasajeros_reservados AS DOUBLE) / nullif(capacidad_pasajeros, 0))", 6
)

SOURCE = f"""
source AS (
  SELECT
    'AA' || l_orderkey AS "ID_Vuelo",
    {_AIRLINES}[l_suppkey % 4 + 1] AS "Aerolinea",
    {_AIRPORTS}[l_partkey % 8 + 1] AS "Origen",
    CASE WHEN l_linenumber <> 7
      THEN {_AIRPORTS}[(l_partkey + 1 + l_suppkey % 7) % 8 + 1] END AS "Destino",
    CAST(l_shipdate AS DATE) AS "Fecha_Programada",
    lpad(CAST(l_linenumber + 6 AS VARCHAR), 2, '0') || ':30' AS "Hora_Salida_UTC",
    CAST(l_partkey + 500 AS INTEGER) AS "Distancia_KM",
    CASE WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN NULL
      ELSE {_SEATS}[l_partkey % 4 + 1] END AS "Capacidad_Pasajeros",
    CAST({_SEATS}[l_partkey % 4 + 1] * CAST(l_quantity AS INTEGER) // 50 AS INTEGER)
      AS "Pasajeros_Reservados",
    {_CLASSES}[l_linenumber % 3 + 1] AS "Clase_Tarifa",
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.01::DECIMAL(3,2) AS DECIMAL(14,4))
      AS "Costo_Base",
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
      * CAST(nullif(l_tax, 0) AS DECIMAL(4,2)) * 0.01::DECIMAL(3,2), 4) AS DECIMAL(14,4))
      AS "Impuestos",
    {_PLANES}[l_partkey % 4 + 1] AS "Tipo_Avion"
  FROM lineitem
)"""

_BRONZE_COLUMNS = """
    "ID_Vuelo" AS id_vuelo, "Aerolinea" AS info_aerolinea, "Origen" AS geo_origen,
    "Destino" AS geo_destino, "Fecha_Programada" AS fecha_programada,
    "Hora_Salida_UTC" AS hora_salida_utc, "Distancia_KM" AS op_distancia_km,
    "Capacidad_Pasajeros" AS capacidad_pasajeros,
    "Pasajeros_Reservados" AS op_pasajeros_reservados, "Clase_Tarifa" AS tarifa_clase,
    "Costo_Base" AS tarifa_costo_base, "Impuestos" AS tarifa_impuestos,
    "Tipo_Avion" AS op_tipo_avion"""

BRONZE = f"{SOURCE}, bronze AS (SELECT {_BRONZE_COLUMNS} FROM source)"

SILVER = f"""{BRONZE},
priced AS (
  SELECT *, round(tarifa_costo_base + tarifa_impuestos, 2) AS total FROM bronze
),
silver AS (
  SELECT * EXCLUDE (total),
    CAST(year(fecha_programada) AS INTEGER) AS analisis_anio,
    CAST(month(fecha_programada) AS INTEGER) AS analisis_mes,
    CAST(dayofweek(fecha_programada) + 1 AS INTEGER) AS analisis_dia_semana,
    total AS tarifa_precio_total_ticket,
    coalesce(total < 400.00, false) AS indicador_es_bajo_costo,
    geo_origen || '-' || geo_destino AS geo_id_ruta,
    {_MILES} AS op_distancia_millas,
    CASE WHEN capacidad_pasajeros >= 300 THEN 1 ELSE 0 END AS indicador_alta_capacidad
  FROM priced
)"""


def _plain(source: str, *, numbers: str = "", texts: str = "", drop: str = "", also: str = "") -> str:
    """Final SELECT: the named columns as double or as text, others as they are."""
    changed = [f"CAST({c} AS DOUBLE) AS {c}" for c in numbers.split()]
    changed += [f"CAST({c} AS VARCHAR) AS {c}" for c in texts.split()]
    if also:
        changed.append(also)
    without = f" EXCLUDE ({drop})" if drop else ""
    return f"SELECT *{without} REPLACE ({', '.join(changed)}) FROM {source}"


_FLIGHT_NUMBERS = """op_distancia_km capacidad_pasajeros op_pasajeros_reservados
    tarifa_costo_base tarifa_impuestos"""
_SILVER_NUMBERS = f"""{_FLIGHT_NUMBERS} analisis_anio analisis_mes analisis_dia_semana
    tarifa_precio_total_ticket indicador_alta_capacidad"""
_SILVER_TEXTS = "fecha_programada indicador_es_bajo_costo"
_STATE_NUMBERS = "tracking_timestamp_evento tracking_retraso_minutos tracking_nivel_servicio"
_GOLD_NUMBERS = """dim_anio dim_mes gld_vuelos_contados gld_pasajeros_totales
    gld_capacidad_total gld_vuelos_bajo_costo"""

GOLD = f"""{SILVER},
totals AS (
  SELECT analisis_anio AS dim_anio, analisis_mes AS dim_mes,
    info_aerolinea AS dim_aerolinea, geo_id_ruta AS dim_ruta_id,
    CAST(round(sum(tarifa_precio_total_ticket), 2) AS DOUBLE) AS gld_ingreso_total,
    count(id_vuelo) AS gld_vuelos_contados,
    CAST(sum(op_pasajeros_reservados) AS BIGINT) AS gld_pasajeros_totales,
    CAST(sum(capacidad_pasajeros) AS BIGINT) AS gld_capacidad_total,
    CAST(sum(CASE WHEN indicador_es_bajo_costo THEN 1 ELSE 0 END) AS BIGINT)
      AS gld_vuelos_bajo_costo
  FROM silver GROUP BY ALL
),
gold AS (
  SELECT *,
    {_LOAD_PERCENT} AS gld_load_factor_porc,
    {_PER_PASSENGER} AS gld_precio_promedio_ticket
  FROM totals
)"""

EVENTS = """
message AS (
  SELECT event_id, user_id, ts, value, event_type,
    event_id % 71 <> 0 AS readable,
    CASE event_type WHEN 'error' THEN 'Retrasado' WHEN 'signup' THEN 'Cancelado'
      WHEN 'click' THEN 'En Vuelo' WHEN 'view' THEN 'Aterrizado'
      ELSE 'Puerta Asignada' END AS state
  FROM events
),
parsed AS (
  SELECT user_id % 4 AS hub,
    CASE WHEN NOT readable OR event_id % 59 = 0 THEN NULL
      WHEN event_id % 53 = 0 THEN '   '
      WHEN event_id % 50 = 0 THEN 'AA' || user_id || '_ERR'
      ELSE 'AA' || user_id END AS "ID_Vuelo",
    CASE WHEN readable AND event_id % 61 <> 0 THEN ts END AS "Timestamp_Evento",
    CASE WHEN NOT readable THEN NULL
      WHEN event_id % 2 = 0 THEN ' ' || state || '  '
      WHEN event_id % 3 = 0 THEN lower(state)
      ELSE state END AS "Estado_Actual",
    CAST(CASE WHEN NOT readable OR (event_type = 'error' AND event_id % 7 = 0) THEN NULL
      WHEN event_type = 'error' THEN floor(value) - 5
      WHEN event_type = 'signup' THEN 999
      ELSE 0 END AS INTEGER) AS "Retraso_Minutos",
    CASE WHEN readable THEN ['A', 'B', 'C'][event_id % 3 + 1] || (user_id % 20 + 1) END
      AS "Puerta_Asignada",
    CASE WHEN readable THEN 'SCL->MIA' END AS "Ruta_Evento",
    CAST(CASE WHEN NOT readable THEN NULL
      WHEN event_type = 'error' THEN event_id % 2 + 2
      WHEN event_type = 'signup' THEN 3
      ELSE 1 END AS INTEGER) AS "Nivel_Servicio",
    CASE WHEN readable THEN CAST(value + 5000 AS FLOAT) END AS "Consumo_Combustible_Litros"
  FROM message
),
clean AS (
  SELECT * FROM parsed
  WHERE "ID_Vuelo" IS NOT NULL AND trim("ID_Vuelo") <> ''
    AND NOT contains("ID_Vuelo", '_ERR') AND "Timestamp_Evento" IS NOT NULL
)"""


def _events_out(source: str) -> str:
    return _plain(
        source,
        numbers='"Retraso_Minutos" "Nivel_Servicio" "Consumo_Combustible_Litros"',
        drop="hub",
        also='CAST(epoch_us("Timestamp_Evento") AS DOUBLE) AS "Timestamp_Evento"',
    )


_UNREADABLE = """
SELECT event_id AS "sequenceNumber", 'not json' AS body FROM events WHERE event_id % 71 = 0"""


def _with_state(source: str) -> str:
    """``stated``: the rows of ``source`` with normalised state, corrected delay
    and high-delay flag."""
    return f"""
normal AS (
  SELECT *, upper(trim("Estado_Actual")) AS estado_actual_normalizado FROM {source}
),
delayed AS (
  SELECT *, CASE
      WHEN estado_actual_normalizado = 'RETRASADO'
        AND ("Retraso_Minutos" IS NULL OR "Retraso_Minutos" <= 0) THEN 15
      ELSE "Retraso_Minutos" END AS tracking_retraso_minutos
  FROM normal
),
stated AS (
  SELECT *, coalesce(tracking_retraso_minutos >= 60, false) AS indicador_retraso_alto
  FROM delayed
)"""


_STATE_COLUMNS = """"ID_Vuelo" AS tracking_key,
    epoch_us("Timestamp_Evento") AS tracking_timestamp_evento,
    estado_actual_normalizado, tracking_retraso_minutos, indicador_retraso_alto,
    "Puerta_Asignada" AS tracking_puerta_asignada, "Ruta_Evento" AS tracking_ruta_evento,
    "Nivel_Servicio" AS tracking_nivel_servicio,
    CAST("Consumo_Combustible_Litros" AS DOUBLE) AS tracking_consumo_combustible_litros"""

_NEWEST = """ORDER BY "Timestamp_Evento" DESC, "Estado_Actual" DESC,
      "Retraso_Minutos" DESC NULLS LAST, "Puerta_Asignada" DESC, "Ruta_Evento" DESC,
      "Nivel_Servicio" DESC, "Consumo_Combustible_Litros" DESC"""

LATEST = f"""{EVENTS},{_with_state("clean")},
latest AS (
  SELECT {_STATE_COLUMNS}
  FROM stated
  QUALIFY row_number() OVER (PARTITION BY "ID_Vuelo" {_NEWEST}) = 1
)"""

_LATEST_OUT = _plain("latest", numbers=_STATE_NUMBERS, texts="indicador_retraso_alto")

_JOINED_NUMBERS = f"{_SILVER_NUMBERS} {_STATE_NUMBERS}"
_JOINED_TEXTS = f"{_SILVER_TEXTS} indicador_retraso_alto"

_JOINED = f"WITH {SILVER},{LATEST} " + _plain(
    "silver LEFT JOIN latest ON id_vuelo = tracking_key",
    numbers=_JOINED_NUMBERS,
    texts=_JOINED_TEXTS,
    drop="tracking_key",
)


def _active(numbers: str = _JOINED_NUMBERS) -> str:
    return _plain(
        "latest LEFT JOIN silver ON id_vuelo = tracking_key",
        numbers=numbers,
        texts=_JOINED_TEXTS,
        drop="tracking_key",
        also="tracking_key AS id_vuelo",
    )


_ACTIVE = f"WITH {SILVER},{LATEST} {_active()}"


def _on_uneven_flights(sql: str) -> str:
    """The same query with the whole business class on flight AA7."""
    crowded = """(SELECT * REPLACE (
    CASE WHEN tarifa_clase = 'Negocios' THEN 'AA7' ELSE id_vuelo END AS id_vuelo) FROM silver) AS s"""
    return sql.replace("FROM silver LEFT JOIN", f"FROM {crowded} LEFT JOIN").replace(
        "LEFT JOIN silver ON", f"LEFT JOIN {crowded} ON"
    )


_GOLD_OUT = f"WITH {GOLD} " + _plain("gold", numbers=_GOLD_NUMBERS)

_PICKED_DATE = "fecha_programada >= DATE '1997-01-01'"
_PICKED_YEAR = "analisis_anio IN (1997, 1999)"
_PICKED_MONTH = "analisis_mes IN (2, 3, 11)"


_FLIGHTS_MONTH = f"""WITH {SILVER}
SELECT analisis_mes, count(*) AS registros, count(DISTINCT id_vuelo) AS vuelos_distintos
FROM silver
WHERE fecha_programada BETWEEN DATE '1996-03-01' AND DATE '2000-10-31'
  AND analisis_anio IN (1996, 1998, 2000)
GROUP BY analisis_mes"""


def _options(column: str, *others: str) -> str:
    shown, kind = column, "BIGINT"
    if column == "fecha_programada":
        shown, kind = f"CAST({column} AS VARCHAR) AS {column}", "DOUBLE"
    return f"""WITH {SILVER}
SELECT {shown}, CAST(count_if({" AND ".join(others)}) AS {kind}) AS asociados
FROM silver GROUP BY {column}"""


def _draw(seed: int, key: str, group: int, word: int) -> str:
    """32 bits of the digest of seed, key and group."""
    digest = f"md5(concat_ws(':', '{seed}', {key}, '{group}'))"
    return f"CAST('0x' || substr({digest}, {8 * word + 1}, 8) AS BIGINT)"


_FARE_CASES = {
    "Costo_Base": (0, ((150, 600), (800, 2500), (3000, 8000))),
    "Impuestos": (1, ((50, 100), (100, 300), (300, 800))),
}


def _fare(column: str) -> str:
    word, ranges = _FARE_CASES[column]
    draw = _draw(43, "o_orderkey", 0, word)
    cases = " ".join(
        f"WHEN {n} THEN {low * 100} + {draw} % {(high - low) * 100 + 1}"
        for n, (low, high) in enumerate(ranges)
    )
    return f"CAST(CASE fare_class {cases} END AS DOUBLE) / 100"


def _flight_draw(n: int) -> str:
    return _draw(42, "o_orderkey", n // 4, n % 4)


GENERATED = f"""
drawn AS (
  SELECT o_orderkey,
    ['AA', 'LA', 'IB', 'DL'][{_flight_draw(0)} % 4 + 1] || (100 + {_flight_draw(1)} % 9900)
      AS "ID_Vuelo",
    {_AIRLINES}[{_flight_draw(2)} % 4 + 1] AS "Aerolinea",
    {_flight_draw(3)} % 8 AS origin,
    1 + {_flight_draw(4)} % 7 AS step,
    DATE '2025-01-01' + CAST({_flight_draw(5)} % 366 AS INTEGER) AS day,
    lpad(CAST({_flight_draw(6)} % 24 AS VARCHAR), 2, '0') || ':'
      || ['00', '30'][{_flight_draw(7)} % 2 + 1] AS "Hora_Salida_UTC",
    {_flight_draw(8)} % 4 AS plane,
    6000 + {_flight_draw(9)} % 4001 AS load,
    {_flight_draw(10)} AS leg,
    {_flight_draw(11)} % 3 AS fare_class
  FROM orders
),
generated AS (
  SELECT "ID_Vuelo", "Aerolinea",
    {_AIRPORTS}[origin + 1] AS "Origen",
    {_AIRPORTS}[(origin + step) % 8 + 1] AS "Destino",
    CAST(CAST(day AS DATE) AS VARCHAR) AS "Fecha_Programada",
    "Hora_Salida_UTC",
    CAST(CASE WHEN plane IN (0, 3) THEN 2000 + leg % 8001 ELSE 500 + leg % 4001 END AS INTEGER)
      AS "Distancia_KM",
    CAST({_SEATS}[plane + 1] AS INTEGER) AS "Capacidad_Pasajeros",
    CAST({_SEATS}[plane + 1] * load // 10000 AS INTEGER) AS "Pasajeros_Reservados",
    {_CLASSES}[fare_class + 1] AS "Clase_Tarifa",
    {_fare("Costo_Base")} AS "Costo_Base",
    {_fare("Impuestos")} AS "Impuestos",
    {_PLANES}[plane + 1] AS "Tipo_Avion"
  FROM drawn
)"""

_FLIGHT_KEY = '"ID_Vuelo", "Fecha_Programada", "Hora_Salida_UTC"'


def _event_states(draw: Callable[[int], str]) -> str:
    """Fault and state of each row of ``slots``."""
    return f"""
faults AS (
  SELECT *, CASE WHEN {draw(8)} % 1000 < 40 THEN {draw(9)} % 4 ELSE -1 END AS fault
  FROM slots
),
states AS (
  SELECT *,
    CASE WHEN fault = 3 THEN 'Retrasado' ELSE
      ['En Vuelo', 'Aterrizado', 'Retrasado', 'Cancelado', 'Puerta Asignada']
        [{draw(1)} % 5 + 1] END AS state
  FROM faults
)"""


def _event_rows(draw: Callable[[int], str]) -> str:
    return f"""
SELECT
  CASE fault WHEN 0 THEN "ID_Vuelo" || '_ERR' WHEN 1 THEN '  ' ELSE "ID_Vuelo" END AS "ID_Vuelo",
  CASE WHEN fault <> 2 THEN
    CAST(epoch_us(TIMESTAMP '2025-01-01') + ({draw(0)} % 31536000) * 1000000 AS DOUBLE)
  END AS "Timestamp_Evento",
  state AS "Estado_Actual",
  CAST(CASE WHEN fault = 3 THEN 0 WHEN state = 'Retrasado' THEN 15 + {draw(2)} % 166
    WHEN state = 'Cancelado' THEN 999 ELSE 0 END AS DOUBLE) AS "Retraso_Minutos",
  ['A', 'B', 'C'][{draw(4)} % 3 + 1] || (1 + {draw(5)} % 20) AS "Puerta_Asignada",
  'SCL->MIA' AS "Ruta_Evento",
  CAST(CASE state WHEN 'Retrasado' THEN 2 + {draw(3)} % 2 WHEN 'Cancelado' THEN 3 ELSE 1 END
    AS DOUBLE) AS "Nivel_Servicio",
  CAST(CAST(CAST(500000 + {draw(6)} % 2500001 AS DOUBLE) / 100 AS FLOAT) AS DOUBLE)
    AS "Consumo_Combustible_Litros"
FROM states"""


def _flight_event(n: int) -> str:
    return _draw(44, f"{_FLIGHT_KEY}, slot", n // 4, n % 4)


def _slot_event(n: int) -> str:
    return _draw(44, "slot", n // 4, n % 4)


GENERATED_EVENTS = f"""{GENERATED},
counted AS (
  SELECT {_FLIGHT_KEY}, {_draw(42, _FLIGHT_KEY, 0, 0)} % 5 AS n FROM generated
),
slots AS (
  SELECT {_FLIGHT_KEY}, unnest(range(1, n + 1)) AS slot FROM counted
),{_event_states(_flight_event)}"""

COUNTED_EVENTS = f"""{GENERATED},
known AS (
  SELECT "ID_Vuelo", row_number() OVER (ORDER BY substr(md5("ID_Vuelo"), 1, 3), "ID_Vuelo") - 1
    AS number
  FROM (SELECT DISTINCT "ID_Vuelo" FROM generated)
),
drawn_flights AS (
  SELECT event_id AS slot, CASE WHEN {_draw(45, "event_id", 0, 0)} % 1000 < 300 THEN 0
    ELSE {_draw(45, "event_id", 0, 1)} % (SELECT count(*) FROM known) END AS number
  FROM events
),
slots AS (
  SELECT slot, "ID_Vuelo" FROM drawn_flights JOIN known USING (number)
),{_event_states(_slot_event)}"""

ORACLES: dict[str, str] = {
    "rename_project": f"WITH {BRONZE} "
    + _plain("bronze", numbers=_FLIGHT_NUMBERS, texts="fecha_programada"),
    "require_not_null": f"WITH {SOURCE} "
    + _plain(
        """source
WHERE "ID_Vuelo" IS NOT NULL AND "Origen" IS NOT NULL AND "Destino" IS NOT NULL""",
        numbers='''"Distancia_KM" "Capacidad_Pasajeros" "Pasajeros_Reservados"
            "Costo_Base" "Impuestos"''',
        texts='"Fecha_Programada"',
    ),
    "ingest_bronze": f"WITH {BRONZE} "
    + _plain(
        "(SELECT *, 'true' AS ingestion_date FROM bronze)",
        numbers=_FLIGHT_NUMBERS,
        texts="fecha_programada",
    ),
    "calendar_parts": f"WITH {SILVER} "
    + _plain(
        """(SELECT id_vuelo, fecha_programada, analisis_anio, analisis_mes, analisis_dia_semana
  FROM silver)""",
        numbers="analisis_anio analisis_mes analisis_dia_semana",
        texts="fecha_programada",
    ),
    "ticket_total": f"WITH {SILVER} "
    + _plain(
        """(SELECT id_vuelo, tarifa_costo_base, tarifa_impuestos, tarifa_precio_total_ticket
  FROM silver)""",
        numbers="tarifa_costo_base tarifa_impuestos tarifa_precio_total_ticket",
    ),
    "low_cost_flag": f"WITH {SILVER} "
    + _plain(
        "(SELECT id_vuelo, tarifa_precio_total_ticket, indicador_es_bajo_costo FROM silver)",
        numbers="tarifa_precio_total_ticket",
        texts="indicador_es_bajo_costo",
    ),
    "route_key": f"WITH {SILVER} SELECT id_vuelo, geo_origen, geo_destino, geo_id_ruta FROM silver",
    "km_to_miles": f"WITH {SILVER} SELECT id_vuelo, op_distancia_km, op_distancia_millas FROM silver",
    "high_capacity_flag": f"WITH {SILVER} "
    + _plain(
        "(SELECT id_vuelo, capacidad_pasajeros, indicador_alta_capacidad FROM silver)",
        numbers="capacidad_pasajeros indicador_alta_capacidad",
    ),
    "silver_flights": f"WITH {SILVER} "
    + _plain("silver", numbers=_SILVER_NUMBERS, texts=_SILVER_TEXTS),
    "gold_monthly": _GOLD_OUT,
    "gold_airline_month": f"""WITH {SILVER}
SELECT info_aerolinea AS dim_aerolinea, CAST(analisis_anio AS DOUBLE) AS dim_anio,
  CAST(analisis_mes AS DOUBLE) AS dim_mes,
  CAST(sum(tarifa_precio_total_ticket) AS DOUBLE) AS ingreso_total,
  {_MEAN_LOAD} AS load_factor_promedio
FROM silver GROUP BY ALL""",
    "gold_schema": f"""WITH {GOLD}, counted AS (
  SELECT count(dim_anio) AS dim_anio, count(dim_mes) AS dim_mes,
    count(dim_aerolinea) AS dim_aerolinea, count(dim_ruta_id) AS dim_ruta_id,
    count(gld_ingreso_total) AS gld_ingreso_total,
    count(gld_vuelos_contados) AS gld_vuelos_contados,
    count(gld_pasajeros_totales) AS gld_pasajeros_totales,
    count(gld_capacidad_total) AS gld_capacidad_total,
    count(gld_vuelos_bajo_costo) AS gld_vuelos_bajo_costo,
    count(gld_load_factor_porc) AS gld_load_factor_porc,
    count(gld_precio_promedio_ticket) AS gld_precio_promedio_ticket
  FROM gold
), long AS (UNPIVOT counted ON COLUMNS(*) INTO NAME columna VALUE valores)
SELECT columna, valores, CASE
    WHEN columna IN ('dim_anio', 'dim_mes') THEN 'int'
    WHEN columna LIKE 'dim%' THEN 'string'
    WHEN columna IN ('gld_ingreso_total', 'gld_load_factor_porc', 'gld_precio_promedio_ticket')
      THEN 'double'
    ELSE 'bigint' END AS tipo
FROM long""",
    "csv_by_name": f"WITH {BRONZE} "
    + _plain(
        "bronze",
        numbers=_FLIGHT_NUMBERS.replace("op_distancia_km", ""),
        texts="fecha_programada",
        also="""CASE WHEN tarifa_clase = 'Económica' AND op_distancia_km % 200 = 0 THEN NULL
    ELSE CAST(op_distancia_km AS DOUBLE) END AS op_distancia_km""",
    ),
    "csv_bad_cells": f"""WITH {BRONZE}, bad AS (
  SELECT count(*) AS n FROM bronze WHERE tarifa_clase = 'Económica' AND op_distancia_km % 200 = 0
)
SELECT columna, CASE columna WHEN 'Distancia_KM' THEN n ELSE 0 END AS celdas_invalidas
FROM bad, (VALUES ('Fecha_Programada'), ('Distancia_KM'), ('Capacidad_Pasajeros'),
  ('Pasajeros_Reservados'), ('Costo_Base'), ('Impuestos')) AS c(columna)""",
    "csv_profile": f"""WITH {SOURCE}, counted AS (
  SELECT count("ID_Vuelo") AS "ID_Vuelo", count("Aerolinea") AS "Aerolinea",
    count("Origen") AS "Origen", count("Destino") AS "Destino",
    count("Fecha_Programada") AS "Fecha_Programada", count("Hora_Salida_UTC") AS "Hora_Salida_UTC",
    count("Tipo_Avion") AS "Tipo_Avion", count("Capacidad_Pasajeros") AS "Capacidad_Pasajeros",
    count("Pasajeros_Reservados") AS "Pasajeros_Reservados", count("Distancia_KM") AS "Distancia_KM",
    count("Clase_Tarifa") AS "Clase_Tarifa", count("Costo_Base") AS "Costo_Base",
    count("Impuestos") AS "Impuestos"
  FROM source
), long AS (UNPIVOT counted ON COLUMNS(*) INTO NAME columna VALUE valores)
SELECT columna, valores, CASE
    WHEN columna = 'Fecha_Programada' THEN 'date'
    WHEN columna = 'Hora_Salida_UTC' THEN 'timestamp'
    WHEN columna IN ('Capacidad_Pasajeros', 'Pasajeros_Reservados') THEN 'int'
    WHEN columna IN ('Costo_Base', 'Impuestos') THEN 'double'
    ELSE 'string' END AS tipo
FROM long""",
    "parse_json": f"WITH {EVENTS} {_events_out('parsed')}",
    "unreadable_events": _UNREADABLE,
    "stream_rejects": _UNREADABLE,
    "clean_tracking": f"WITH {EVENTS} {_events_out('clean')}",
    "normalize_state": f"""WITH {EVENTS},{_with_state("parsed")}
SELECT "ID_Vuelo", "Estado_Actual", estado_actual_normalizado FROM stated""",
    "delay_correction": f"""WITH {EVENTS},{_with_state("parsed")}
SELECT "ID_Vuelo", estado_actual_normalizado,
  CAST("Retraso_Minutos" AS DOUBLE) AS "Retraso_Minutos",
  CAST(tracking_retraso_minutos AS DOUBLE) AS tracking_retraso_minutos
FROM stated""",
    "high_delay_flag": f"""WITH {EVENTS},{_with_state("parsed")}
SELECT "ID_Vuelo", CAST(tracking_retraso_minutos AS DOUBLE) AS tracking_retraso_minutos,
  CAST(indicador_retraso_alto AS VARCHAR) AS indicador_retraso_alto
FROM stated""",
    "latest_state": f"WITH {LATEST} {_LATEST_OUT}",
    "latest_state_by_max": f"WITH {LATEST} {_LATEST_OUT}",
    "latest_state_enriched": _JOINED,
    "latest_state_enriched_salted": _on_uneven_flights(_JOINED),
    "active_enriched_salted": _on_uneven_flights(_ACTIVE),
    "active_enriched": _ACTIVE,
    "bi_dataset": _JOINED,
    "bi_total": f"WITH {SILVER} SELECT count(*) AS total_vuelos FROM silver",
    "bi_total_filtered": f"""WITH {SILVER} SELECT count(*) AS total_vuelos FROM silver
WHERE {_PICKED_DATE} AND {_PICKED_YEAR} AND {_PICKED_MONTH}""",
    "bi_passengers_month": f"""WITH {SILVER}
SELECT analisis_mes, CAST(sum(op_pasajeros_reservados) AS BIGINT) AS pasajeros
FROM silver GROUP BY analisis_mes""",
    "bi_flights_month": _FLIGHTS_MONTH,
    "bi_flights_month_summary": _FLIGHTS_MONTH,
    "bi_summary": f"""WITH {SILVER}
SELECT CAST(fecha_programada AS VARCHAR) AS fecha_programada,
  CAST(analisis_anio AS DOUBLE) AS analisis_anio, CAST(analisis_mes AS DOUBLE) AS analisis_mes,
  id_vuelo, CAST(count(*) AS DOUBLE) AS registros,
  CAST(sum(op_pasajeros_reservados) AS DOUBLE) AS op_pasajeros_reservados
FROM silver GROUP BY ALL""",
    "bi_filter_options_month": _options("analisis_mes", _PICKED_DATE, _PICKED_YEAR),
    "bi_filter_options_year": _options("analisis_anio", _PICKED_DATE, _PICKED_MONTH),
    "bi_filter_options_date": _options("fecha_programada", _PICKED_YEAR, _PICKED_MONTH),
    "stream_bronze": f"""WITH {EVENTS}, fields AS (
  SELECT event_id AS "sequenceNumber", epoch_us(message.ts) AS "enqueuedTime",
    CAST(user_id % 4 AS VARCHAR) AS "partition", readable,
    concat_ws(',',
      CASE WHEN event_id % 59 = 0 THEN NULL
        WHEN event_id % 53 = 0 THEN '"ID_Vuelo":"   "'
        WHEN event_id % 50 = 0 THEN '"ID_Vuelo":"AA' || user_id || '_ERR"'
        ELSE '"ID_Vuelo":"AA' || user_id || '"' END,
      CASE WHEN event_id % 61 <> 0
        THEN '"Timestamp_Evento":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"' END,
      '"Estado_Actual":"' || CASE WHEN event_id % 2 = 0 THEN ' ' || state || '  '
        WHEN event_id % 3 = 0 THEN lower(state) ELSE state END || '"',
      CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN NULL
        WHEN event_type = 'error' THEN '"Retraso_Minutos":' || CAST(floor(value) - 5 AS INTEGER)
        WHEN event_type = 'signup' THEN '"Retraso_Minutos":999'
        ELSE '"Retraso_Minutos":0' END,
      '"Puerta_Asignada":"' || ['A', 'B', 'C'][event_id % 3 + 1] || (user_id % 20 + 1) || '"',
      '"Ruta_Evento":"SCL->MIA"',
      '"Nivel_Servicio":' || CASE event_type WHEN 'error' THEN event_id % 2 + 2
        WHEN 'signup' THEN 3 ELSE 1 END,
      '"Consumo_Combustible_Litros":' || CAST(CAST(value + 5000 AS FLOAT) AS VARCHAR)
    ) AS text
  FROM message
)
SELECT CAST("sequenceNumber" AS DOUBLE) AS "sequenceNumber",
  CAST("enqueuedTime" AS DOUBLE) AS "enqueuedTime", "partition",
  CASE WHEN readable THEN '{{' || text || '}}' ELSE 'not json' END AS body
FROM fields""",
    "stream_silver": f"WITH {EVENTS} {_events_out('parsed')}",
    "stream_gold": _JOINED,
    "stream_gold_active": _ACTIVE,
    "gold_batches_replayed": f"""WITH {SILVER},{EVENTS},{_with_state("clean")},
latest AS (
  SELECT hub AS batch_id, {_STATE_COLUMNS}
  FROM stated
  QUALIFY row_number() OVER (PARTITION BY hub, "ID_Vuelo" {_NEWEST}) = 1
)
{_active(f"batch_id {_JOINED_NUMBERS}")}""",
    "stream_preview": """
SELECT least(count(*), 20) AS filas, least(count(*), 20) AS filas_conocidas FROM events""",
    "stream_current": f"WITH {LATEST} {_LATEST_OUT}",
    "stream_current_log": f"WITH {LATEST} {_LATEST_OUT}",
    "stream_current_compacted": f"WITH {LATEST} {_LATEST_OUT}",
    "operational_state": _ACTIVE,
    "batch_chain": _GOLD_OUT,
    "silver_partitioned": f"""WITH {SILVER}
SELECT analisis_mes, CAST(sum(op_pasajeros_reservados) AS BIGINT) AS pasajeros
FROM silver WHERE {_PICKED_DATE} AND {_PICKED_YEAR} AND {_PICKED_MONTH}
GROUP BY analisis_mes""",
    "table_lifecycle": f"""WITH {BRONZE}
SELECT info_aerolinea, count(*) AS vuelos, CAST(sum(capacidad_pasajeros) AS BIGINT) AS capacidad,
  false AS borrador_existe, false AS esquema_existe, CAST(0 AS INTEGER) AS carpetas_quedan,
  true AS en_su_carpeta
FROM bronze GROUP BY info_aerolinea""",
    "gold_batches_new_column": f"""WITH {SILVER}
SELECT CAST(CASE WHEN analisis_mes <= 6 THEN 0 ELSE 1 END AS DOUBLE) AS batch_id,
  CAST(count(*) AS DOUBLE) AS vuelos,
  CAST(count(CASE WHEN analisis_mes > 6 THEN info_aerolinea END) AS DOUBLE) AS con_aerolinea
FROM silver WHERE analisis_mes IS NOT NULL GROUP BY 1""",
    "generate_flights": f"WITH {GENERATED} "
    + _plain(
        "generated", numbers='"Distancia_KM" "Capacidad_Pasajeros" "Pasajeros_Reservados"'
    ),
    "generate_events": f"WITH {GENERATED_EVENTS}{_event_rows(_flight_event)}",
    "generate_events_count": f"WITH {COUNTED_EVENTS}{_event_rows(_slot_event)}",
}

# The stored table has the rows of the frame it is made from.
ORACLES["airline_month_table"] = ORACLES["gold_airline_month"]
# Four batches that each wrote all flights show every flight once, with its state.
ORACLES["gold_current"] = _JOINED
ORACLES["gold_merged"] = ORACLES["gold_reloaded"] = _JOINED
ORACLES["gold_reloaded_active"] = _ACTIVE
ORACLES["bi_total_merged"] = ORACLES["bi_total"]
ORACLES["gold_empty_batch"] = f"""WITH {SILVER}
SELECT CAST(batch_id AS DOUBLE) AS batch_id, CAST((SELECT count(*) FROM silver) AS DOUBLE) AS vuelos
FROM (VALUES (0), (2)) AS batches(batch_id)"""
ORACLES["active_enriched_parts"] = _ACTIVE.replace(
    "FROM latest LEFT JOIN", "FROM (SELECT * FROM latest WHERE tracking_key LIKE '%7') AS latest LEFT JOIN"
)
ORACLES["bi_total_gold"] = ORACLES["bi_total"]
ORACLES["bi_passengers_month_gold"] = ORACLES["bi_passengers_month"]
ORACLES["bi_filter_options_gold"] = ORACLES["bi_filter_options_month"]

_BATCHED = f"""{EVENTS},{_with_state("clean")},
batched AS (
  SELECT *, epoch_us("Timestamp_Evento") AS us, (day("Timestamp_Evento") - 1) // 10
    + CASE WHEN epoch_us("Timestamp_Evento") % 9 = 0 THEN 1 ELSE 0 END AS b
  FROM stated
),
clocks AS (
  SELECT x.b, max(y.us) AS clock
  FROM (SELECT DISTINCT b FROM batched) x JOIN batched y ON y.b < x.b GROUP BY x.b
),
taken AS (
  SELECT * FROM batched LEFT JOIN clocks USING (b)
  WHERE clock IS NULL OR clock - us <= 6 * 3600000000
)"""
ORACLES["stream_current_expiring"] = f"""WITH {_BATCHED},
newest AS (
  SELECT * FROM taken QUALIFY row_number() OVER (PARTITION BY "ID_Vuelo" {_NEWEST}) = 1
),
latest AS (
  SELECT {_STATE_COLUMNS} FROM newest, (SELECT max(us) AS now FROM batched)
  WHERE now - us <= 24 * 3600000000
    AND NOT (estado_actual_normalizado IN ('ATERRIZADO', 'CANCELADO') AND now - us > 6 * 3600000000)
)
{_LATEST_OUT}"""
ORACLES["late_events"] = f"""WITH {_BATCHED}
SELECT CAST((SELECT count(*) FROM batched) AS DOUBLE) AS eventos,
  CAST((SELECT count(*) FROM batched) - (SELECT count(*) FROM taken) AS DOUBLE) AS tardios,
  CAST((SELECT max(us) FROM batched) AS DOUBLE) AS hasta"""

ORACLES["bi_flights_month_bitmap"] = ORACLES["bi_flights_month"]
ORACLES["bi_options_bitmap"] = ORACLES["bi_filter_options_month"]
ORACLES["gold_monthly_incremental"] = _GOLD_OUT
ORACLES["gold_airline_incremental"] = ORACLES["gold_airline_month"]
ORACLES["batch_chain_resumed"] = f"SELECT *, 'true' AS cargas_iguales FROM ({_GOLD_OUT})"

_PACED = COUNTED_EVENTS.replace(
    "  FROM events\n",
    "  FROM (SELECT unnest(range(3 * CAST(ceil(count(*) / 3.0) AS BIGINT))) AS event_id FROM customer)\n",
)
ORACLES["paced_events"] = f"WITH {_PACED}{_event_rows(_slot_event)}"
_FIELDS = (
    "ID_Vuelo Timestamp_Evento Estado_Actual Retraso_Minutos Puerta_Asignada Ruta_Evento "
    "Nivel_Servicio Consumo_Combustible_Litros"
).split()
ORACLES["stream_counts"] = f"""WITH {EVENTS}
SELECT CAST(count(*) AS DOUBLE) AS filas,
  CAST(count_if(coalesce({", ".join(f'CAST("{f}" AS VARCHAR)' for f in _FIELDS)}) IS NULL) AS DOUBLE) AS rechazadas,
  {", ".join(f'CAST(count_if("{f}" IS NULL) AS DOUBLE) AS sin_{f.lower()}' for f in _FIELDS)}
FROM parsed"""
