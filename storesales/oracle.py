"""The same results in ANSI SQL over the test tables, for an independent engine.

Each query is a WITH chain: source tables, clean tables, consolidated rows.
"""

from __future__ import annotations

RAW = {
    "raw_base": """
        SELECT (l_orderkey * 10 + l_linenumber) * 2 AS id,
               CAST(l_shipdate AS DATE) AS date,
               CAST(l_suppkey AS INT) AS store_nbr,
               p_brand AS family,
               CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_extendedprice END AS sales,
               CASE WHEN l_orderkey % 89 = 0 THEN NULL
                    WHEN p_brand = 'Brand#1' OR l_discount < 0.055 THEN 0
                    ELSE CAST(round(l_discount * 100) AS INT) END AS onpromotion
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "raw_train": """
        SELECT * FROM raw_base
        UNION ALL
        SELECT id + 1, date, store_nbr, family, sales, onpromotion
        FROM raw_base WHERE id % 102 = 0""",
    "raw_store": """
        SELECT CAST(s_suppkey AS INT) AS store_nbr,
               CASE WHEN s_suppkey % 31 = 3 THEN NULL ELSE n_name END AS city,
               CASE WHEN s_suppkey % 37 = 4 THEN NULL ELSE r_name END AS state,
               CASE WHEN s_suppkey % 29 = 5 THEN NULL
                    ELSE substr('ABCDE', CAST(s_suppkey % 5 AS INT) + 1, 1) END AS type,
               CAST(s_suppkey % 17 + 1 AS INT) AS cluster
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "raw_stores": """
        SELECT * FROM raw_store UNION ALL SELECT * FROM raw_store WHERE store_nbr % 10 = 0""",
    "raw_traffic": """
        SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS INT) AS store_nbr,
               CAST(sum(l_quantity) AS BIGINT) AS quantity
        FROM lineitem GROUP BY ALL""",
    "raw_transactions": """
        SELECT date, store_nbr,
               CASE WHEN (store_nbr + extract(day FROM date)) % 13 = 0 THEN NULL ELSE quantity END AS transactions
        FROM raw_traffic WHERE (store_nbr + extract(day FROM date)) % 11 <> 0""",
    "raw_price": """
        SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS price FROM orders GROUP BY 1""",
    "raw_oil": """
        SELECT date,
               CASE WHEN extract(day FROM date) % 7 IN (0, 1) THEN NULL
                    ELSE CAST(CAST(price / 5000 AS DECIMAL(12, 2)) AS DOUBLE) END AS dcoilwtico
        FROM raw_price""",
    "raw_days": """
        SELECT date, extract(month FROM date) AS m, extract(day FROM date) AS dd
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)""",
    "raw_holidays": """
        SELECT date,
               CASE WHEN m = 11 THEN NULL WHEN m % 4 = 3 THEN 'Event' ELSE 'Holiday' END AS type,
               'National' AS locale, 'Ecuador' AS locale_name,
               concat('N', CAST(m AS VARCHAR(2))) AS description,
               CASE WHEN m = 7 THEN NULL ELSE m = 5 END AS transferred
        FROM raw_days WHERE dd IN (1, 25)
        UNION ALL
        SELECT date, 'Holiday', 'Local', 'Quito', concat('L', CAST(m AS VARCHAR(2))), false
        FROM raw_days WHERE dd = 25 AND m % 2 = 0""",
}


def _mode(table: str, column: str) -> str:
    return (
        f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


CLEAN = {
    "train_first": """
        SELECT min(id) AS id, date, store_nbr, family, sales, onpromotion
        FROM raw_train GROUP BY date, store_nbr, family, sales, onpromotion""",
    "train": """
        SELECT id, date, store_nbr, family, coalesce(sales, 0.0) AS sales, coalesce(onpromotion, 0) AS onpromotion
        FROM train_first""",
    "stores_once": "SELECT DISTINCT * FROM raw_stores",
    "stores": f"""
        SELECT store_nbr,
               coalesce(city, {_mode("stores_once", "city")}) AS city,
               coalesce(state, {_mode("stores_once", "state")}) AS state,
               coalesce(type, {_mode("stores_once", "type")}) AS type,
               cluster
        FROM stores_once""",
    "transactions_once": "SELECT DISTINCT * FROM raw_transactions",
    "transactions": """
        SELECT date, store_nbr,
               coalesce(CAST(transactions AS DOUBLE), (SELECT median(transactions) FROM transactions_once)) AS transactions
        FROM transactions_once""",
    "oil_once": """
        SELECT date, dcoilwtico, row_number() OVER (ORDER BY date) AS rn FROM (SELECT DISTINCT * FROM raw_oil)""",
    "oil_sides": """
        SELECT date, dcoilwtico, rn,
               last_value(dcoilwtico IGNORE NULLS) OVER back AS pv,
               last_value(CASE WHEN dcoilwtico IS NOT NULL THEN rn END IGNORE NULLS) OVER back AS pr,
               first_value(dcoilwtico IGNORE NULLS) OVER ahead AS nv,
               first_value(CASE WHEN dcoilwtico IS NOT NULL THEN rn END IGNORE NULLS) OVER ahead AS nr
        FROM oil_once
        WINDOW back AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               ahead AS (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "oil_linear": """
        SELECT date, pv, nv,
               CASE WHEN dcoilwtico IS NOT NULL THEN dcoilwtico
                    WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (rn - pr) / (nr - pr)
               END AS dcoilwtico
        FROM oil_sides""",
    "oil": "SELECT date, coalesce(dcoilwtico, pv, nv) AS dcoilwtico FROM oil_linear",
    "holidays_once": "SELECT DISTINCT * FROM raw_holidays",
    "holidays": f"""
        SELECT date,
               coalesce(type, {_mode("holidays_once", "type")}) AS type,
               coalesce(locale, {_mode("holidays_once", "locale")}) AS locale,
               coalesce(locale_name, {_mode("holidays_once", "locale_name")}) AS locale_name,
               coalesce(description, {_mode("holidays_once", "description")}) AS description,
               coalesce(transferred, false) AS transferred
        FROM holidays_once""",
}

WIDE = {
    "holiday_days": """
        SELECT date,
               coalesce(bool_or(type = 'Holiday'), false) AS es_feriado,
               coalesce(bool_or(transferred), false) AS feriado_transferido,
               min({'a': locale, 'b': locale_name, 'c': description}) AS firsts
        FROM holidays GROUP BY date""",
    "holiday_summary": """
        SELECT date, es_feriado, feriado_transferido, firsts.a AS feriado_locale,
               firsts.b AS feriado_locale_name, firsts.c AS feriado_descripcion
        FROM holiday_days""",
    "consolidated": """
        SELECT t.id, t.date, t.store_nbr, t.family, t.sales, t.onpromotion,
               s.city, s.state, s.type, s.cluster, x.transactions, o.dcoilwtico,
               coalesce(h.es_feriado, false) AS es_feriado,
               coalesce(h.feriado_transferido, false) AS feriado_transferido,
               h.feriado_locale, h.feriado_locale_name, h.feriado_descripcion
        FROM train t
        LEFT JOIN stores s ON t.store_nbr = s.store_nbr
        LEFT JOIN transactions x ON t.store_nbr = x.store_nbr AND t.date = x.date
        LEFT JOIN oil o ON t.date = o.date
        LEFT JOIN holiday_summary h ON t.date = h.date""",
    "facts": """
        SELECT *, CAST(extract(year FROM date) AS INT) AS anio, CAST(extract(month FROM date) AS INT) AS mes,
               onpromotion > 0 AS tiene_promocion,
               CAST(sales AS DECIMAL(18, 2)) AS amount, CAST(dcoilwtico AS DECIMAL(22, 6)) AS price
        FROM consolidated""",
}

TOTAL = "CAST(sum(amount) AS DOUBLE)"
MEAN = "CAST(sum(amount) AS DOUBLE) / count(amount)"


def _mean_if(condition: str) -> str:
    return (
        f"CAST(sum(amount) FILTER (WHERE {condition}) AS DOUBLE)"
        f" / nullif(count(amount) FILTER (WHERE {condition}), 0)"
    )


def _change(new: str, base: str) -> str:
    return f"100.0 * ({new} - {base}) / nullif({base}, 0)"


FALL = "anio BETWEEN 1997 AND 1998"

TABLES = {
    "sales_by_family": f"SELECT family, {TOTAL} AS ventas_totales FROM facts GROUP BY family",
    "sales_by_store": f"SELECT store_nbr, {TOTAL} AS ventas_totales FROM facts GROUP BY store_nbr",
    "avg_sales_by_city": f"SELECT city, {MEAN} AS ventas_promedio FROM facts GROUP BY city",
    "avg_sales_by_state": f"SELECT state, {MEAN} AS ventas_promedio FROM facts GROUP BY state",
    "sales_monthly": f"SELECT anio, mes, {TOTAL} AS ventas_totales FROM facts GROUP BY anio, mes",
    "sales_yearly": f"SELECT anio, {TOTAL} AS ventas_totales FROM facts GROUP BY anio",
    "holiday_vs_normal": f"""
        SELECT es_feriado, {MEAN} AS ventas_promedio, {TOTAL} AS ventas_totales, count(*) AS num_registros
        FROM facts GROUP BY es_feriado""",
    "sales_around_holidays": f"""
        SELECT CAST(k.k AS INT) AS offset_dias, f.family, {MEAN} AS ventas_promedio
        FROM (SELECT DISTINCT date FROM facts WHERE es_feriado) e, range(-3, 4) k(k), facts f
        WHERE f.date = e.date + CAST(k.k AS INT)
        GROUP BY 1, 2""",
    "holiday_sensitivity": f"""
        SELECT *, CAST({_change("ventas_promedio_feriado", "ventas_promedio_normal")} AS DOUBLE) AS variacion_porcentual
        FROM (SELECT family, {_mean_if("NOT es_feriado")} AS ventas_promedio_normal,
                     {_mean_if("es_feriado")} AS ventas_promedio_feriado
              FROM facts GROUP BY family)
        WHERE ventas_promedio_normal IS NOT NULL AND ventas_promedio_feriado IS NOT NULL""",
    "sales_promo_split": f"""
        SELECT family, tiene_promocion, {MEAN} AS ventas_promedio FROM facts GROUP BY family, tiene_promocion""",
    "promo_effect": f"""
        SELECT *, CAST({_change('"true"', '"false"')} AS DOUBLE) AS efecto_promocion_pct
        FROM (SELECT family, {_mean_if("tiene_promocion")} AS "true", {_mean_if("NOT tiene_promocion")} AS "false"
              FROM facts GROUP BY family)""",
    "sales_vs_oil_monthly": f"""
        SELECT * FROM (
            SELECT anio, mes, {TOTAL} AS ventas_totales,
                   CAST(sum(price) AS DOUBLE) / nullif(count(price), 0) AS precio_petroleo_promedio
            FROM facts GROUP BY anio, mes)
        WHERE precio_petroleo_promedio IS NOT NULL AND ventas_totales IS NOT NULL""",
    "sales_city_period": f"""
        SELECT city, CASE WHEN {FALL} THEN 'caida_petroleo' ELSE 'otro_periodo' END AS periodo,
               {MEAN} AS ventas_promedio
        FROM facts GROUP BY 1, 2""",
    "city_period_sensitivity": f"""
        SELECT *, CAST({_change("caida_petroleo", "otro_periodo")} AS DOUBLE) AS variacion_pct
        FROM (SELECT city, {_mean_if(FALL)} AS caida_petroleo, {_mean_if(f"NOT ({FALL})")} AS otro_periodo
              FROM facts GROUP BY city)""",
    "avg_ticket_by_store": f"""
        SELECT *, ventas_totales / nullif(transacciones_promedio, 0) AS ticket_promedio
        FROM (SELECT store_nbr, sum(transactions) / nullif(count(transactions), 0) AS transacciones_promedio,
                     {TOTAL} AS ventas_totales
              FROM facts GROUP BY store_nbr)""",
}


def _ranked(table: str, value: str, key: str, n: int, last: bool = False) -> str:
    order = f"{value} ASC, {key} DESC" if last else f"{value} DESC, {key} ASC"
    return f"SELECT * FROM ({TABLES[table]}) WHERE {value} IS NOT NULL ORDER BY {order} LIMIT {n}"


def _corr(x: str, y: str) -> str:
    """Pearson correlation to six places, NULL where it is undefined."""
    return f"round(CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END, 6)"


FINDINGS = {
    "top_family": _ranked("sales_by_family", "ventas_totales", "family", 1),
    "top_stores": _ranked("sales_by_store", "ventas_totales", "store_nbr", 10),
    "bottom_stores": _ranked("sales_by_store", "ventas_totales", "store_nbr", 10, last=True),
    "top_holiday_families": _ranked("holiday_sensitivity", "variacion_porcentual", "family", 5),
    "top_promo_families": _ranked("promo_effect", "efecto_promocion_pct", "family", 5),
    "most_sensitive_cities": f"""
        SELECT * FROM ({TABLES["city_period_sensitivity"]})
        WHERE variacion_pct IS NOT NULL ORDER BY variacion_pct, city LIMIT 5""",
    "high_ticket_stores": _ranked("avg_ticket_by_store", "ticket_promedio", "store_nbr", 5),
    "low_ticket_stores": _ranked("avg_ticket_by_store", "ticket_promedio", "store_nbr", 5, last=True),
    "corr_oil_sales": f"""
        SELECT {_corr("ventas_totales", "precio_petroleo_promedio")} AS correlacion
        FROM ({TABLES["sales_vs_oil_monthly"]})""",
    "corr_oil_sales_lags": f"""
        SELECT k AS lag_meses, {_corr("ventas_totales", "base")} AS correlacion
        FROM (SELECT CAST(l.k AS INT) AS k, ventas_totales,
                     lag(precio_petroleo_promedio, CAST(l.k AS INT))
                         OVER (PARTITION BY l.k ORDER BY anio, mes) AS base
              FROM ({TABLES["sales_vs_oil_monthly"]}), range(1, 4) l(k)
              WHERE {FALL})
        WHERE base IS NOT NULL GROUP BY k HAVING count(*) >= 2""",
    "corr_transactions_sales": f"""
        SELECT {_corr("transacciones_promedio", "ventas_totales")} AS correlacion
        FROM ({TABLES["avg_ticket_by_store"]})""",
}

# Column types of the source tables as Spark names them.
COLUMN_TYPES = {
    "train": "id bigint, date date, store_nbr int, family string, sales double, onpromotion int",
    "stores": "store_nbr int, city string, state string, type string, cluster int",
    "transactions": "date date, store_nbr int, transactions bigint",
    "oil": "date date, dcoilwtico double",
    "holidays": "date date, type string, locale string, locale_name string, description string, transferred boolean",
}


def _profile_table(name: str) -> str:
    columns = [c.split()[0] for c in COLUMN_TYPES[name].split(", ")]
    compared = ", ".join(c for c in columns if c != "id")
    span = ("CAST(min(date) AS VARCHAR)", "CAST(max(date) AS VARCHAR)")
    low, high = span if "date" in columns else ("CAST(NULL AS VARCHAR)",) * 2
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {compared} FROM raw_{name}))"
    return f"""
        SELECT '{name}' AS archivo, count(*) AS filas, {len(columns)} AS columnas,
               count(*) - {distinct} AS filas_duplicadas,
               coalesce(round(CAST(100.0 * (count(*) - {distinct}) AS DOUBLE) / nullif(count(*), 0), 4), 0.0)
                   AS porcentaje_duplicadas,
               {low} AS fecha_minima, {high} AS fecha_maxima
        FROM raw_{name}"""


def _profile_columns(name: str) -> str:
    rows = []
    for field in COLUMN_TYPES[name].split(", "):
        column, kind = field.split()
        nulls = f"count(*) - count({column})"
        rows.append(
            f"SELECT '{name}' AS archivo, '{column}' AS columna, '{kind}' AS tipo, {nulls} AS nulos, "
            f"coalesce(round(CAST(100.0 * ({nulls}) AS DOUBLE) / nullif(count(*), 0), 2), 0.0) "
            f"AS porcentaje_nulos FROM raw_{name}"
        )
    return " UNION ALL ".join(rows)


# Metric name -> the columns whose NULLs it counts.
METRICS = {
    "train": {
        "nulos_sales_imputados_con_0": ["sales"],
        "nulos_onpromotion_imputados_con_0": ["onpromotion"],
    },
    "stores": {"nulos_categoricos_imputados_con_moda": ["city", "state", "type"]},
    "transactions": {"nulos_transactions_imputados_con_mediana": ["transactions"]},
    "oil": {"nulos_oil_imputados_con_interpolacion_lineal": ["dcoilwtico"]},
    "holidays": {
        "nulos_categoricos_imputados_con_moda": ["type", "locale", "locale_name", "description"],
        "nulos_transferred_imputados_con_false": ["transferred"],
    },
}


def _cleaning_metrics() -> str:
    names = list(dict.fromkeys(m for metrics in METRICS.values() for m in metrics))
    rows = []
    for name, metrics in METRICS.items():
        once = "train_first" if name == "train" else f"{name}_once"

        def nulls(metric: str) -> str:
            if metric not in metrics:
                return f"CAST(NULL AS BIGINT) AS {metric}"
            return " + ".join(f"(count(*) - count({c}))" for c in metrics[metric]) + f" AS {metric}"

        rows.append(
            f"SELECT '{name}' AS archivo, (SELECT count(*) FROM raw_{name}) - count(*) AS duplicados_removidos, "
            f"{', '.join(nulls(m) for m in names)}, count(*) AS filas_finales FROM {once}"
        )
    return " UNION ALL ".join(rows)


# Public name of each table -> its query, and its main measure.
PUBLIC_TABLES = {
    "ventas_por_familia": ("sales_by_family", "ventas_totales"),
    "ventas_por_tienda": ("sales_by_store", "ventas_totales"),
    "ventas_promedio_por_ciudad": ("avg_sales_by_city", "ventas_promedio"),
    "ventas_promedio_por_provincia": ("avg_sales_by_state", "ventas_promedio"),
    "evolucion_ventas_mensual": ("sales_monthly", "ventas_totales"),
    "evolucion_ventas_anual": ("sales_yearly", "ventas_totales"),
    "ventas_feriado_vs_normal": ("holiday_vs_normal", "ventas_promedio"),
    "ventas_alrededor_feriados_por_familia": ("sales_around_holidays", "ventas_promedio"),
    "sensibilidad_familias_feriados": ("holiday_sensitivity", "variacion_porcentual"),
    "ventas_con_sin_promocion_por_familia": ("sales_promo_split", "ventas_promedio"),
    "efecto_promocion_por_familia": ("promo_effect", "efecto_promocion_pct"),
    "ventas_vs_petroleo_mensual": ("sales_vs_oil_monthly", "ventas_totales"),
    "ventas_ciudad_periodo_petroleo": ("sales_city_period", "ventas_promedio"),
    "sensibilidad_ciudades_petroleo": ("city_period_sensitivity", "variacion_pct"),
    "ticket_promedio_por_tienda": ("avg_ticket_by_store", "ticket_promedio"),
}

# Public name of each ranking -> its query, key and measure.
PUBLIC_RANKINGS = {
    "top_10_tiendas": (FINDINGS["top_stores"], "store_nbr", "ventas_totales"),
    "bottom_10_tiendas": (FINDINGS["bottom_stores"], "store_nbr", "ventas_totales"),
    "impacto_feriados": (TABLES["holiday_vs_normal"], "es_feriado", "ventas_totales"),
    "familias_mas_sensibles_a_feriados": (FINDINGS["top_holiday_families"], "family", "variacion_porcentual"),
    "familias_con_mayor_efecto_promocion": (FINDINGS["top_promo_families"], "family", "efecto_promocion_pct"),
    "ciudades_mas_sensibles_caida_petroleo": (FINDINGS["most_sensitive_cities"], "city", "variacion_pct"),
    "tiendas_ticket_alto": (FINDINGS["high_ticket_stores"], "store_nbr", "ticket_promedio"),
    "tiendas_ticket_bajo": (FINDINGS["low_ticket_stores"], "store_nbr", "ticket_promedio"),
}

OPERATORS = {
    "csv_load": "SELECT * FROM raw_train",
    "partitioned_checkpoint": """
        SELECT CAST(extract(year FROM date) AS INT) AS anio, count(*) AS filas
        FROM consolidated WHERE extract(year FROM date) >= 1997 GROUP BY 1""",
    "event_windows": """
        SELECT e.date AS date_feriado, CAST(k.k AS INT) AS offset_dias, count(*) AS num_registros
        FROM (SELECT DISTINCT date FROM consolidated WHERE es_feriado) e, range(-3, 4) k(k), consolidated c
        WHERE c.date = e.date + CAST(k.k AS INT)
        GROUP BY 1, 2""",
    "job_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, count(*) AS filas, max({value}) AS valor_maximo FROM ({TABLES[query]})"
        for name, (query, value) in PUBLIC_TABLES.items()
    ),
    "summary_report": " UNION ALL ".join(
        f"SELECT '{name}' AS hallazgo, CAST({key} AS VARCHAR) AS clave, {value} AS valor FROM ({query})"
        for name, (query, key, value) in PUBLIC_RANKINGS.items()
    ),
    "exported_tables": "SELECT 'ventas_consolidado' AS tabla, count(*) AS filas FROM consolidated UNION ALL "
    + " UNION ALL ".join(
        f"SELECT 'eda_{name}' AS tabla, count(*) AS filas FROM ({TABLES[query]})"
        for name, (query, _) in PUBLIC_TABLES.items()
    ),
    "profile_tables": " UNION ALL ".join(_profile_table(n) for n in COLUMN_TYPES),
    "profile_columns": " UNION ALL ".join(_profile_columns(n) for n in COLUMN_TYPES),
    "dedup_full_row": "SELECT * FROM stores_once",
    "dedup_keep_first": "SELECT * FROM train_first",
    "lenient_casts": """
        SELECT id,
               TRY_CAST(CASE WHEN id % 7 = 0 THEN 'no date' ELSE CAST(date AS VARCHAR) END AS DATE) AS date,
               TRY_CAST(CASE WHEN id % 11 = 0 THEN 'x' ELSE CAST(store_nbr AS VARCHAR) || '.0' END AS DOUBLE)::INT
                   AS store_nbr,
               TRY_CAST(CASE WHEN id % 13 = 0 THEN '' ELSE CAST(sales AS DECIMAL(18, 2))::VARCHAR END AS DOUBLE) AS sales,
               CASE WHEN id % 17 <> 0 THEN onpromotion > 0 END AS tiene_promocion
        FROM raw_train""",
    "impute_mode": "SELECT * FROM stores",
    "impute_median": "SELECT * FROM transactions",
    "interpolate_oil": "SELECT date, dcoilwtico FROM oil_linear",
    "fill_forward": "SELECT date, pv AS dcoilwtico FROM oil_sides",
    "fill_backward": "SELECT date, nv AS dcoilwtico FROM oil_sides",
    "clean_sales": "SELECT * FROM train",
    "clean_stores": "SELECT * FROM stores",
    "clean_transactions": "SELECT * FROM transactions",
    "clean_oil": "SELECT * FROM oil",
    "clean_holidays": "SELECT * FROM holidays",
    "cleaning_metrics": _cleaning_metrics(),
    "holiday_summary": "SELECT * FROM holiday_summary",
    "flagship_consolidated": "SELECT * FROM consolidated",
    "join_cardinality": """
        SELECT (SELECT count(*) FROM train) AS base_rows, (SELECT count(*) FROM consolidated) AS output_rows,
               (SELECT count(*) FROM train) = (SELECT count(*) FROM consolidated) AS preserved""",
}

CHAIN = {**RAW, **CLEAN, **WIDE}


def oracle_sql() -> dict[str, str]:
    """Query name -> complete SQL."""
    chain = ",\n".join(f"{name} AS ({sql})" for name, sql in CHAIN.items())
    return {name: f"WITH {chain}\n{sql}" for name, sql in {**OPERATORS, **TABLES, **FINDINGS}.items()}
