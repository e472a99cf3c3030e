"""Pieces of the SQL that the queries are compared with."""

from __future__ import annotations

from collections.abc import Mapping

from txlab.functions.draws import SEED
from txlab.operators.sampling import STEP_PRIMES
from txlab.sources.ledger import CATEGORY_OF_TYPE, FRAUD_OF_PRIORITY


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def text_list(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def pairs(values: Mapping) -> str:
    """A VALUES list of a literal table."""
    return ", ".join(
        f"({text(k)}, {text(v) if isinstance(v, str) else v})" for k, v in values.items()
    )


def _case(column: str, values: Mapping[str, str], default: str) -> str:
    rules = " ".join(f"WHEN {column} = {text(k)} THEN {text(v)}" for k, v in values.items())
    return f"{rules} ELSE {text(default)} END"


TX = f"""tx AS (
  SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(l_quantity AS INT), CAST(l_shipdate AS DATE)) AS tx_id,
         l_orderkey AS case_id,
         o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS tx_date,
         CASE {_case('p_type', CATEGORY_OF_TYPE, 'Shopping')} AS category,
         p_brand AS subcategory, p_name AS description, l_extendedprice AS amount,
         CASE WHEN l_linestatus = 'F' THEN 'income' ELSE 'spending' END AS tx_type,
         CASE WHEN NOT (l_returnflag = 'R' AND l_quantity >= 49) THEN 'none'
              {_case('o_orderpriority', FRAUD_OF_PRIORITY, 'CEO')} AS fraud_type,
         concat('bank_', c_nationkey % 5) AS bank_from,
         CASE WHEN p_type = 'PROMO' THEN NULL ELSE concat('bank_', s_nationkey % 5) END AS bank_to
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


def on_tx(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([TX, *ctes]) + "\n" + body


def _hex(digest: str, start: int) -> str:
    return f"(('0x' || substr({digest}, {start}, 13))::BIGINT / 4503599627370496::DOUBLE)"


def _digest(salt: str, *keys: str, seed: int = SEED) -> str:
    return f"md5(concat_ws('|', '{seed}|{salt}', {', '.join(keys)}))"


def u(salt: str, *keys: str, seed: int = SEED) -> str:
    return _hex(_digest(salt, *keys, seed=seed), 1)


def index(size, salt: str, *keys: str) -> str:
    return f"CAST(floor({u(salt, *keys)} * {size}) AS BIGINT)"


def integer(low, high, salt: str, *keys: str) -> str:
    return f"({low} + CAST(floor({u(salt, *keys)} * ({high} - {low} + 1)) AS BIGINT))"


def between(low, high, salt: str, *keys: str) -> str:
    return f"({low}::DOUBLE + ({high}::DOUBLE - {low}::DOUBLE) * {u(salt, *keys)})"


def choice(values, salt: str, *keys: str) -> str:
    return f"{text_list(values)}[1 + {index(len(values), salt, *keys)}]"


def day(start: str, end: str, salt: str, *keys: str) -> str:
    days = f"(({end}) - ({start}) + 1)"
    return f"(({start}) + CAST({index(days, salt, *keys)} AS INT))"


def truncated_normal(low: str, high: str, mean: str, salt: str, *keys: str) -> str:
    digest = _digest(salt, *keys, "i")
    value = (
        f"{mean} + (({high} - {low}) / 4.0::DOUBLE) * "
        f"(sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_hex(digest, 1)})) * "
        f"cos(2 * pi() * {_hex(digest, 14)}))"
    )
    return (
        f"list_filter(list_transform(range(32), lambda i: {value}), "
        f"lambda x: x > {low} AND x < {high})[1]"
    )


def distinct_position(size: str, draw: str, salt: str, *keys: str) -> str:
    usable = f"list_filter({list(STEP_PRIMES)}::BIGINT[], lambda p: {size} % p <> 0)"
    prime = lambda n: f"{usable}[1 + {index(f'len({usable})', f'{salt}-step{n}', *keys)}]"
    step = f"(({prime(1)} * {prime(2)}) % {size})"
    return f"(({index(size, salt, *keys)} + {draw} * {step}) % {size})"


def rank(salt: str, key: str, by: str = "", prefix: str = "", seed: int = SEED) -> str:
    partition = f"PARTITION BY {by} " if by else ""
    order = f"{prefix}, " if prefix else ""
    return f"row_number() OVER ({partition}ORDER BY {order}{u(salt, key, seed=seed)}, {key})"


def exact_mean(column: str) -> str:
    return f"(CAST(sum(CAST({column} AS DECIMAL(38,10))) AS DOUBLE) / count({column}))"


def exact_sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(38,10))) AS DOUBLE)"


LAST_FRIDAY = "(last_day({d}) - CAST((isodow(last_day({d})) + 2) % 7 AS INT))"


def last_friday(date: str) -> str:
    return LAST_FRIDAY.format(d=date)
