"""The registered queries as plain SQL, written independently of the operators.

Each statement is put together from named steps; only the steps a query needs are included.
"""

from __future__ import annotations

import re

from types import SimpleNamespace

# Written out, not taken from the operators: a wrong constant there must not pass here.
SEED, TRAIN_SHARE = 42, 0.8
DAMPING, ITERATIONS, TOP_REPORT = 0.85, 5, 20
TOKEN_THRESHOLDS = USER_THRESHOLDS = (10, 20, 50)
TOP_N = 10
TX_RANGE = ("2024-01-05", "2024-01-20")
TRANSFER_RANGE = ("1996-01-01", "1998-01-01")
CONTRACT_RANGE = ("2023-01-01", "2026-04-01")
DAYS_READ = ("1997-01-15", "1997-04-20")
SLICE_DAYS = ("1994-06-01", "1996-06-01")
POPULAR = 20
TOP_K, MID_K, LOW_K = 100, 150, 250
RANK_DIGITS = 9
S = SimpleNamespace(
    max_decimals=18, exchange_tx_limit=40, min_tx=20, min_holders=10, safe_min_holders=20, trending_low=10,
    trending_high=25,
)


def _address(key: str) -> str:
    return f"concat('0x', lpad(lower(to_hex({key})), 40, '0'))"


ZERO = "0x" + "0" * 40

STEPS: dict[str, str] = {
    # Sample views
    "tokens": f"""
        select {_address('p_partkey')} as address, p_brand as symbol, p_name as name,
               p_size as decimals,
               cast(cast(round(p_retailprice * 100) as bigint) as varchar) as total_supply
        from part""",
    "transfers": f"""
        select {_address('l_partkey')} as token_address, {_address('o_custkey')} as from_address,
               {_address('l_suppkey * 10 + l_linenumber')} as to_address,
               concat(cast(cast(l_quantity as bigint) as varchar), repeat('0', p_size),
                      case when l_linenumber = 7 then repeat('0', 40) else '' end) as value,
               {_address('l_orderkey')} as transaction_hash, l_shipdate as block_timestamp
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "raw_contracts": f"""
        select {_address('c_custkey')} as address, c_nationkey % 2 = 0 as is_erc20,
               c_nationkey % 5 = 0 as is_erc721,
               cast(date '2022-06-01' + cast(c_custkey as int) as date) as block_timestamp
        from customer where c_mktsegment = 'MACHINERY'""",
    "all_contracts": f"""
        select {_address('c_custkey')} as address, c_nationkey % 2 = 0 as is_erc20,
               c_nationkey % 5 = 0 as is_erc721,
               cast(date '2022-06-01' + cast(c_custkey as int) as date) as block_timestamp
        from customer""",
    "fractional_there": f"""
        select {_address('l_partkey')} as token, {_address('o_custkey')} as sender,
               {_address('l_suppkey * 10 + l_linenumber')} as receiver, l_linenumber as line,
               cast(round(l_extendedprice * 100) as hugeint) as amount, l_shipdate as day
        from lineitem join orders on l_orderkey = o_orderkey""",
    "fractional_moves": """
        select token, receiver as wallet, amount, day from fractional_there
        union all select token, sender, -amount, day from fractional_there
        union all select token, sender, amount, day from fractional_there where line % 3 = 0
        union all select token, receiver, -amount, day from fractional_there where line % 3 = 0""",
    "raw_transactions": f"""
        select {_address('event_id')} as hash, {_address('user_id')} as from_address,
               case when event_id % 97 = 0 then null else {_address('event_id % 100')} end
                   as to_address,
               cast(concat(cast(cast(round(value * 100) as bigint) as varchar),
                           repeat('0', 16)) as decimal(38, 9)) as value,
               ts as block_timestamp, value as gas_price,
               case when event_type = 'error' then 0 else 1 end as receipt_status
        from events""",
    "transactions": "select from_address, block_timestamp, gas_price from raw_transactions",
    "requests": """
        select cast(c_custkey as varchar) as user_id,
               case when c_nationkey % 2 = 0 then 'safe' when c_nationkey % 3 = 0 then null
                    else 'daring' end as risk_mode
        from customer""",
    # Clean and portfolio
    "clean_tokens": f"""
        select address, decimals, symbol, name, total_supply from (
            select lower(address) as address, decimals, symbol, name, total_supply,
                   row_number() over (partition by lower(address)
                                      order by decimals, symbol, name, total_supply) as place
            from tokens where decimals is not null and decimals <= {S.max_decimals})
        where place = 1""",
    "normalized": """
        select transaction_hash, from_address, to_address,
               try_cast(value as decimal(38, 0))::double / pow(10::double, decimals)
                   as adjusted_value,
               block_timestamp, token_address, name, symbol, decimals
        from transfers join clean_tokens on lower(token_address) = address""",
    "flows": """
        select lower(to_address) as user_address, lower(token_address) as token_address,
               adjusted_value as value, block_timestamp from normalized
        union all
        select lower(from_address), lower(token_address), -adjusted_value, block_timestamp
        from normalized""",
    "portfolios": """
        select user_address, token_address, sum(value) as balance, count(*) as tx_count,
               max(block_timestamp) as last_active
        from flows where user_address is not null
        group by user_address, token_address having sum(value) > 0""",
    "contracts": "select distinct lower(address) as address from raw_contracts",
    "labelled": """
        select p.*, exists (select 1 from contracts c where c.address = p.user_address)
                   as is_contract
        from portfolios p""",
    "real_users": f"""
        select user_address, sum(tx_count) as total_tx_count from labelled where not is_contract
        group by user_address having sum(tx_count) < {S.exchange_tx_limit}""",
    "held": """
        select * from labelled
        where not is_contract and user_address in (select user_address from real_users)""",
    "activity": """
        select user_address, count(distinct token_address) as token_count,
               sum(tx_count) as total_tx_count, count(*) as portfolio_rows
        from held group by user_address""",
    # Gas
    "samples": """
        select cast(block_timestamp as date) as date,
               cast(extract(hour from block_timestamp) as int) as hour,
               cast(gas_price as double) as gas_price
        from transactions where block_timestamp is not null and gas_price is not null""",
    # Distribution
    "curve": """
        select tx_value, users, cum_users, cum_tx,
               cum_users / (sum(users) over ())::double as user_share,
               cum_tx / (sum(tx) over ())::double as tx_share
        from (select *, sum(users) over (order by tx_value desc) as cum_users,
                     sum(tx) over (order by tx_value desc) as cum_tx
              from (select total_tx_count as tx_value, count(*) as users,
                           sum(total_tx_count) as tx
                    from activity group by total_tx_count))""",
    # Matrix and ids
    "universe": """
        select distinct user_address from (
            select lower(from_address) as user_address from normalized
            union all select lower(to_address) from normalized)
        where user_address is not null and user_address <> ''""",
    "user_map": """
        select user_address, row_number() over (order by user_address) as user_id
        from universe""",
    "valid_tokens": """
        select distinct lower(trim(address)) as token_address from clean_tokens
        where regexp_matches(lower(trim(address)), '^0x[0-9a-f]{40}$')""",
    "token_map": """
        select token_address, row_number() over (order by token_address) as token_id
        from valid_tokens""",
    "held_users": """
        select user_address, row_number() over (order by user_address) as user_id
        from (select distinct user_address from held)""",
    "held_tokens": """
        select token_address, row_number() over (order by token_address) as token_id
        from (select distinct token_address from held)""",
    "scored": """
        select h.user_address, h.token_address, total_tx, num_holders from held h
        join (select user_address, sum(tx_count) as total_tx from held group by 1) using (user_address)
        join (select token_address, count(distinct user_address) as num_holders
              from held group by 1) using (token_address)""",
    "filtered": f"""
        select * from scored
        where total_tx >= {S.min_tx} and num_holders >= {S.min_holders}""",
    "indexed": """
        select user_id, token_id, total_tx, num_holders
        from filtered join user_map using (user_address) join token_map using (token_address)""",
    "indexed_transfers": """
        select f.user_id as from_user_id, r.user_id as to_user_id, t.token_id, n.adjusted_value
        from normalized n
        left join user_map f on f.user_address = lower(n.from_address)
        left join user_map r on r.user_address = lower(n.to_address)
        left join token_map t on t.token_address = lower(n.token_address)""",
    # Graph
    "edges": """
        select distinct from_user_id as src, to_user_id as dst from indexed_transfers
        where from_user_id <> to_user_id""",
    "vertices": "select src as id from edges union select dst from edges",
    "degrees": "select src, count(*) as out_degree from edges group by src",
    "rank_0": "select id, 1.0::double as pagerank from vertices",
    **{
        f"rank_{i}": f"""
        select v.id, {1 - DAMPING}::double + {DAMPING}::double * coalesce(s.total, 0) as pagerank
        from vertices v left join (
            select e.dst, sum(r.pagerank / d.out_degree) as total
            from edges e join rank_{i - 1} r on r.id = e.src join degrees d on d.src = e.src
            group by e.dst) s on s.dst = v.id"""
        for i in range(1, ITERATIONS + 1)
    },
    "ranks": f"select id, round(pagerank, {RANK_DIGITS}) as pagerank from rank_{ITERATIONS}",
    "top": f"select * from ranks order by pagerank desc, id limit {TOP_K}",
    "mid": f"""
        select * from ranks where pagerank between (select avg(pagerank) from ranks) * 0.8::double
                                            and (select avg(pagerank) from ranks) * 1.2::double
        order by id limit {MID_K}""",
    "low": f"select * from ranks order by pagerank, id limit {LOW_K}",
    # Features
    "scores": f"""
        select id as user_id,
               case when max(pagerank) over () > min(pagerank) over ()
                    then (pagerank - min(pagerank) over ())
                         / (max(pagerank) over () - min(pagerank) over ())
                    else 0.0 end as pagerank_score
        from rank_{ITERATIONS}""",
    "with_scores": """
        select i.*, coalesce(pagerank_score, 0) as pagerank_score
        from indexed i left join scores using (user_id)""",
    "rated": """
        select *, ln(1 + total_tx::double) * (1 + pagerank_score) as ultimate_confidence
        from with_scores""",
    "user_index": """
        select user_id,
               cast(row_number() over (order by n desc, cast(user_id as varchar)) - 1 as int)
                   as user_id_int
        from (select user_id, count(*) as n from indexed group by 1)""",
    "token_index": """
        select token_id,
               cast(row_number() over (order by n desc, cast(token_id as varchar)) - 1 as int)
                   as token_id_int
        from (select token_id, count(*) as n from indexed group by 1)""",
    "interactions": """
        select * from indexed join user_index using (user_id) join token_index using (token_id)""",
    "sides": f"""
        select *, case when ('0x' || substr(md5(concat_ws('|', user_id, token_id, '{SEED}')), 1, 8))
                            ::bigint < {int(TRAIN_SHARE * 2**32)}
                       then 'train' else 'test' end as side
        from interactions""",
    # Recommendations
    "popular": f"""
        select token_id_int, count(*)::double as score from sides where side = 'train'
        group by 1 order by score desc, token_id_int limit {POPULAR}""",
    "test_rows": "select user_id_int, token_id_int from sides where side = 'test'",
    "train_rows": "select user_id, user_id_int, token_id_int from sides where side = 'train'",
    "trained_users": """
        select distinct user_id_int from test_rows
        where user_id_int in (select user_id_int from train_rows)""",
    "recs": """
        select user_id_int,
               row_number() over (partition by user_id_int order by score desc, token_id_int)
                   as rank,
               token_id_int, score
        from (select distinct user_id_int from test_rows), popular""",
    "relevant": "select user_id_int, count(*) as n_rel from test_rows group by 1",
    "cutoffs": "select unnest([5, 10, 20]) as k",
    "ideal": """
        select k, n, sum(1 / log2(i + 1)) as idcg
        from cutoffs, (select unnest(range(1, 21)) as n), (select unnest(range(1, 21)) as i)
        where i <= n and n <= k group by k, n""",
    "user_metrics": """
        select c.k, r.user_id_int, any_value(v.n_rel) as n_rel, count(t.token_id_int) as hits,
               coalesce(sum(case when t.token_id_int is not null then 1 / log2(r.rank + 1) end), 0)
                   as dcg
        from cutoffs c join recs r on r.rank <= c.k
        join relevant v on v.user_id_int = r.user_id_int
        left join test_rows t on t.user_id_int = r.user_id_int and t.token_id_int = r.token_id_int
        group by c.k, r.user_id_int""",
    "metrics": """
        select m.k, round(avg(hits / m.k::double), 4) as precision,
               round(avg(hits / n_rel::double), 4) as recall,
               round(avg(dcg / idcg), 4) as ndcg,
               round(avg(case when hits > 0 then 1.0 else 0.0 end::double), 4) as hit_rate,
               count(*) as users_eval, (select count(*) from relevant) as users_total
        from user_metrics m join ideal d on d.k = m.k and d.n = least(m.n_rel, m.k)
        group by m.k""",
    "safe": f"""
        select *, ln(1 + num_holders::double) * ln(1 + total_volume::double) as safety_score
        from (select token_id_int, token_id, max(num_holders) as num_holders,
                     sum(total_tx) as total_volume
              from interactions where num_holders > {S.safe_min_holders} group by 1, 2)""",
    "trending": f"""
        select *, total_volume / num_holders::double as momentum_score
        from (select token_id_int, token_id, max(num_holders) as num_holders,
                     sum(total_tx) as total_volume
              from interactions
              where num_holders >= {S.trending_low} and num_holders < {S.trending_high}
              group by 1, 2)""",
    "catalogs": f"""
        select * from (
            select 'safe' as source, token_id_int, safety_score as score,
                   row_number() over (order by safety_score desc, token_id_int) as rank from safe
            union all
            select 'trending', token_id_int, momentum_score,
                   row_number() over (order by momentum_score desc, token_id_int) from trending)
        where rank <= {TOP_N}""",
    "model_answers": """
        select source, cast(rank as int) as rank, token_id_int, round(score, 6) as score from catalogs
        union all select 'als', unnest(range(1, 11))::int, null, null""",
    "wallet_requests": f"""
        select case cast(user_id as bigint) % 4 when 0 then concat(' ', upper({_address('cast(user_id as bigint)')}))
                    when 1 then {_address('cast(user_id as bigint)')} when 2 then user_id
                    else concat('wallet ', user_id) end as wallet, risk_mode
        from requests""",
    "wallet_answers": """
        select w.wallet, w.risk_mode, h.user_id_int,
               case when h.user_id_int in (select user_id_int from recs) then 'als'
                    when w.risk_mode = 'safe' then 'safe' else 'trending' end as source
        from (select q.*, coalesce(cast(m.user_id as varchar), trim(wallet)) as user_id
              from wallet_requests q left join user_map m on m.user_address = lower(trim(wallet))) w
        left join (select distinct cast(user_id as varchar) as user_id, user_id_int
                   from interactions) h using (user_id)""",
    "routed": """
        select q.user_id, q.risk_mode, h.user_id_int,
               case when h.user_id_int in (select user_id_int from recs) then 'als'
                    when q.risk_mode = 'safe' then 'safe' else 'trending' end as source
        from requests q
        left join (select distinct cast(user_id as varchar) as user_id, user_id_int
                   from interactions) h using (user_id)""",
}

_HISTOGRAM_EDGES = """
    (select case when lo = hi then lo - 0.5 else lo end as lo,
            case when lo = hi then hi + 0.5 else hi end as hi
     from (select min(total_tx_count)::double as lo, max(total_tx_count)::double as hi
           from activity))"""


def _rounded_columns(names: str, doubles: str, source: str) -> str:
    parts = [n.strip() for n in names.split(",") if n.strip()]
    parts += [f"round({n.strip()}, 6) as {n.strip()}" for n in doubles.split(",")]
    return f"select {', '.join(parts)} from {source}"


_TRANSFER_COLUMNS = (
    "transaction_hash, from_address, to_address, block_timestamp, token_address, "
    "name, symbol, decimals"
)
_HELD_COLUMNS = "user_address, token_address, tx_count, last_active, is_contract"
_BASELINE = """
    select date, hour, round(quantile_disc(gas_price, 0.5), 6) as baseline_gas_price,
           count(*) as n_samples"""


def _sparsity(source: str, user: str, item: str) -> str:
    return f"""
        select entries, users, tokens,
               round(case when users * tokens > 0
                          then (1 - entries / (users * tokens)::double) * 100
                          else 100.0 end, 6) as sparsity_pct
        from (select count(*) as entries, count(distinct {user}) as users,
                     count(distinct {item}) as tokens from {source})"""


FINAL: dict[str, str] = {
    "extract_transactions": f"""
        select hash, from_address, to_address, round(value::double / 1e18, 6) as eth_value,
               block_timestamp, round(gas_price, 6) as gas_price
        from raw_transactions
        where cast(block_timestamp as date) >= date '{TX_RANGE[0]}'
          and cast(block_timestamp as date) < date '{TX_RANGE[1]}'
          and receipt_status = 1 and to_address is not null""",
    "extract_tokens": """
        select * from tokens
        where symbol is not null and name is not null and decimals is not null
          and total_supply is not null and try_cast(total_supply as decimal(38, 9)) > 0""",
    "extract_transfers": f"""
        select token_address, from_address, to_address, value, transaction_hash, block_timestamp
        from transfers
        where cast(block_timestamp as date) >= date '{TRANSFER_RANGE[0]}'
          and cast(block_timestamp as date) < date '{TRANSFER_RANGE[1]}'
          and value <> '0' and to_address is not null and to_address <> '{ZERO}'""",
    "extract_contracts": f"""
        select address, is_erc20, is_erc721 from all_contracts
        where block_timestamp >= date '{CONTRACT_RANGE[0]}'
          and block_timestamp < date '{CONTRACT_RANGE[1]}'""",
    "read_slices": """
        select from_address, block_timestamp, round(gas_price, 6) as gas_price
        from transactions""",
    "read_first_available": "select * from tokens",
    "read_token_csv": """
        select address, symbol, name, cast(decimals as varchar) as decimals, total_supply
        from tokens""",
    "write_table": "select * from all_contracts",
    "catalog_table": "select * from all_contracts",
    "publish_table": "select * from all_contracts",
    "slices_by_day": f"""
        select token_address, from_address, to_address, value, transaction_hash, block_timestamp,
               cast(block_timestamp as date) as day
        from transfers
        where cast(block_timestamp as date) >= date '{DAYS_READ[0]}'
          and cast(block_timestamp as date) < date '{DAYS_READ[1]}'
          and value <> '0' and to_address is not null and to_address <> '{ZERO}'""",
    "balances_over_slices": _rounded_columns(
        "user_address, token_address, tx_count, last_active", "balance", "portfolios"
    ),
    # Wallets are numbered by the slice that first has them, then by address.
    "lasting_ids_over_slices": f"""
        select user_address, row_number() over (order by slice, user_address) as user_id
        from (select user_address, min(slice) as slice
              from (select lower(unnest([from_address, to_address])) as user_address,
                           case when block_timestamp < date '{SLICE_DAYS[0]}' then 0
                                when block_timestamp < date '{SLICE_DAYS[1]}' then 1 else 2 end as slice
                    from normalized)
              where user_address is not null and user_address <> '' group by user_address)""",
    # Ranks found slice by slice must be what one more round over all edges leaves them at.
    "ranks_over_slices": """
        select v.id, coalesce(d.out_degree, 0) as out_degree, true as is_settled
        from vertices v left join degrees d on d.src = v.id""",
    "clean_tokens": "select * from clean_tokens",
    "normalize_transfers": _rounded_columns(_TRANSFER_COLUMNS, "adjusted_value", "normalized"),
    "processed_transfers": _rounded_columns(
        "from_address, to_address, token_address", "adjusted_value", "normalized"
    ),
    "signed_flows": _rounded_columns(
        "user_address, token_address, block_timestamp", "value", "flows"
    ),
    "portfolios": _rounded_columns(
        "user_address, token_address, tx_count, last_active", "balance", "portfolios"
    ),
    "contract_addresses": "select distinct lower(address) as address from all_contracts",
    "portfolios_fractional": """
        select wallet as user_address, token as token_address, count(*) as tx_count, max(day) as last_active,
               round(sum(amount)::double / pow(10, any_value(decimals)), 6) as balance
        from fractional_moves join clean_tokens on token = address
        group by wallet, token having sum(amount) > 0""",
    "label_contracts": _rounded_columns(_HELD_COLUMNS, "balance", "labelled"),
    "label_counts": """
        select count(*) as total, count(*) filter (is_contract) as contracts,
               count(*) filter (not is_contract) as eoa_users
        from labelled""",
    "real_users": "select user_address, cast(total_tx_count as bigint) as total_tx_count from real_users",
    "real_portfolios": _rounded_columns(_HELD_COLUMNS, "balance", "held"),
    "user_activity": """
        select user_address, token_count, cast(total_tx_count as bigint) as total_tx_count,
               portfolio_rows
        from activity""",
    "user_gas_hourly": """
        select user_address, date, hour, round(avg(gas_price), 6) as avg_gas_price
        from (select lower(from_address) as user_address, gas_price,
                     cast(block_timestamp as date) as date,
                     cast(extract(hour from block_timestamp) as int) as hour
              from transactions)
        where user_address in (select user_address from held) group by 1, 2, 3""",
    "gas_cutoff": "select round(quantile_disc(gas_price, 0.95), 6) as cutoff from samples",
    "gas_cutoff_over_slices": """
        select unnest([0.05, 0.5, 0.95])::double as q, (select count(*) from samples) as samples,
               true as sketch_is_near, true as default_is_near""",
    "gas_baseline_hourly": f"""{_BASELINE}
        from samples where gas_price <= (select quantile_disc(gas_price, 0.95) from samples)
        group by date, hour""",
    "gas_baseline_within_hour": f"""{_BASELINE}
        from samples join (select date, hour, quantile_disc(gas_price, 0.95) as cutoff
                           from samples group by date, hour) using (date, hour)
        where gas_price <= cutoff group by date, hour""",
    "activity_histogram": f"""
        select bin, round(lo + bin * (hi - lo) / 50, 6) as lower_edge,
               round(lo + (bin + 1) * (hi - lo) / 50, 6) as upper_edge,
               (select count(*) from activity
                where least(floor((total_tx_count - lo) * 50 / (hi - lo)), 49) = bin) as users
        from (select cast(unnest(range(0, 50)) as int) as bin), {_HISTOGRAM_EDGES}""",
    "pareto_curve": """
        select cast(tx_value as bigint) as tx_value, users, cast(cum_users as bigint) as cum_users,
               cast(cum_tx as bigint) as cum_tx, round(user_share, 6) as user_share,
               round(tx_share, 6) as tx_share
        from curve""",
    "pareto_points": """
        select 0.01::double as top_users,
               (select round((cum_tx - (cum_users - 0.01::double * n) * tx_value) / t, 6)
                from blocks where user_share >= 0.01 order by cum_users limit 1)
                   as tx_share_of_top,
               0.8::double as tx_share,
               (select round((cum_users - (cum_tx - 0.8::double * t) / tx_value) / n, 6)
                from blocks where tx_share >= 0.8 order by cum_users limit 1) as users_for_share""",
    "dense_ids": "select * from held_users",
    "wallet_universe": "select * from universe",
    "valid_token_addresses": "select * from valid_tokens",
    "user_map": "select * from user_map",
    "token_map": "select * from token_map",
    "index_pairs_left": """
        select user_id, token_id, round(balance, 6) as balance, tx_count
        from held left join held_users using (user_address)
        left join held_tokens using (token_address)""",
    "index_pairs": "select user_id, token_id, cast(total_tx as bigint) as total_tx, num_holders from indexed",
    "index_transfers": _rounded_columns(
        "from_user_id, to_user_id, token_id", "adjusted_value", "indexed_transfers"
    ),
    "unmapped_count": """
        select count(*) as transfers,
               count(*) filter (f.user_id is null or r.user_id is null or t.token_id is null)
                   as unmapped
        from normalized n
        left join held_users f on f.user_address = lower(n.from_address)
        left join held_users r on r.user_address = lower(n.to_address)
        left join token_map t on t.token_address = lower(n.token_address)""",
    "sparsity_by_id": _sparsity("indexed", "user_id", "token_id"),
    "sparsity": _sparsity("held", "user_address", "token_address"),
    "user_totals": """
        select user_address, cast(sum(tx_count) as bigint) as total_tx from held group by 1""",
    "token_holders": """
        select token_address, count(distinct user_address) as num_holders from held group by 1""",
    "score_pairs": "select user_address, token_address, cast(total_tx as bigint) as total_tx, num_holders from scored",
    "threshold_grid": f"""
        select min_tx, min_holders, entries, users, tokens,
               round(case when users * tokens > 0
                          then (1 - entries / (users * tokens)::double) * 100
                          else 100.0 end, 4) as sparsity_pct
        from (select min_tx, min_holders, count(user_address) as entries,
                     count(distinct user_address) as users,
                     count(distinct token_address) as tokens
              from (select unnest({list(USER_THRESHOLDS)}) as min_tx),
                   (select unnest({list(TOKEN_THRESHOLDS)}) as min_holders)
              left join scored on total_tx >= min_tx and num_holders >= min_holders
              group by min_tx, min_holders)""",
    "filter_pairs": "select user_address, token_address, cast(total_tx as bigint) as total_tx, num_holders from filtered",
    "filter_pairs_metrics": _sparsity("filtered", "user_address", "token_address"),
    "edges": "select * from edges",
    "vertices": "select * from vertices",
    "out_degrees": "select * from degrees",
    "pagerank": f"select id, round(pagerank, 6) as pagerank from rank_{ITERATIONS}",
    "top_wallets": f"""
        select id, round(pagerank, 6) as pagerank
        from (select * from ranks order by pagerank desc, id limit {TOP_REPORT})""",
    "mid_wallets": "select id, round(pagerank, 6) as pagerank from mid",
    "low_wallets": "select id, round(pagerank, 6) as pagerank from low",
    "stratified_sample": """
        select id, round(pagerank, 6) as pagerank,
               case when id in (select id from top) then 'top'
                    when id in (select id from mid) then 'mid' else 'low' end as tier
        from (select * from top union select * from mid union select * from low)""",
    "correlation_matrix": """
        select 'total_tx' as col_x, 'total_tx' as col_y,
               round(corr(total_tx::double, total_tx::double), 6) as correlation from filtered
        union all select 'total_tx', 'num_holders',
               round(corr(total_tx::double, num_holders::double), 6) from filtered
        union all select 'num_holders', 'total_tx',
               round(corr(num_holders::double, total_tx::double), 6) from filtered
        union all select 'num_holders', 'num_holders',
               round(corr(num_holders::double, num_holders::double), 6) from filtered""",
    "minmax_scale": "select user_id, round(pagerank_score, 6) as pagerank_score from scores",
    "attach_scores": """
        select user_id, token_id, cast(total_tx as bigint) as total_tx, num_holders,
               round(pagerank_score, 6) as pagerank_score
        from with_scores""",
    "score_coverage": """
        select users, users_with_score,
               round(users_with_score / users::double * 100, 6) as coverage_pct
        from (select count(distinct user_id) as users,
                     count(distinct case when pagerank_score > 0 then user_id end)
                         as users_with_score
              from with_scores)""",
    "ultimate_confidence": """
        select user_id, token_id, cast(total_tx as bigint) as total_tx, num_holders,
               round(pagerank_score, 6) as pagerank_score,
               round(ultimate_confidence, 6) as ultimate_confidence
        from rated""",
    "describe_column": """
        select count(ultimate_confidence) as count, round(avg(ultimate_confidence), 6) as mean,
               round(stddev_samp(ultimate_confidence), 6) as stddev,
               round(min(ultimate_confidence), 6) as min,
               round(max(ultimate_confidence), 6) as max
        from rated""",
    "frequency_index": """
        select user_id, token_id, cast(total_tx as bigint) as total_tx, num_holders, user_id_int,
               token_id_int
        from interactions""",
    "train_test_split": """
        select user_id, token_id, cast(total_tx as bigint) as total_tx, num_holders, side
        from sides""",
    "rank_recs": "select user_id_int, cast(rank as int) as rank, token_id_int, score from recs",
    "ground_truth": """
        select user_id_int,
               string_agg(cast(token_id_int as varchar), ',' order by token_id_int)
                   as actual_tokens
        from test_rows group by 1""",
    "ranking_metrics": "select * from metrics",
    "ndcg_at_k": "select ndcg, users_eval as users from metrics where k = 10",
    "catalog_coverage": """
        select covered, catalog, round(covered / catalog::double * 100, 6) as coverage_pct
        from (select count(distinct token_id_int) as covered,
                     (select count(distinct token_id_int) from interactions) as catalog
              from recs where rank <= 10)""",
    "safe_catalog": """
        select token_id_int, token_id, num_holders, cast(total_volume as bigint) as total_volume,
               round(safety_score, 6) as safety_score
        from safe""",
    "trending_catalog": """
        select token_id_int, token_id, num_holders, cast(total_volume as bigint) as total_volume,
               round(momentum_score, 6) as momentum_score
        from trending""",
    # Of a fitted model SQL can tell who has factors and how many.
    "train_als": """
        select distinct user_id_int as id, 50 as factors, true as sound from sides
        where side = 'train'""",
    "certify_model": """
        select user_id_int, count(*) as n_pairs, true as is_feasible, true as is_optimal
        from sides where side = 'train' group by user_id_int""",
    "save_model": """
        select distinct token_id_int as id, 50 as factors, true as sound, true as is_equal from sides
        where side = 'train'""",
    "select_model": """
        select unnest(['rank=30 reg=0.10 alpha=15', 'rank=50 reg=0.10 alpha=15', 'rank=50 reg=0.05 alpha=20',
                       'rank=50 reg=0.01 alpha=25']) as label,
               (select count(*) from trained_users) as users, true as sound""",
    "recommend_top_n": """
        select user_id_int, rank, true as is_product, true as is_ordered, true as is_single
        from trained_users, (select unnest(range(1, 11))::int as rank)""",
    "recommend_unseen": """
        select user_id_int, rank, false as is_seen
        from (select user_id_int, (select count(distinct token_id_int) from train_rows) - count(*) as unseen
              from train_rows group by 1) join trained_users using (user_id_int),
             (select unnest(range(1, 11))::int as rank)
        where rank <= unseen""",
    "als_ranking_metrics": """
        select unnest([5, 10, 20]) as k, (select count(*) from trained_users) as users_eval,
               (select count(distinct user_id_int) from test_rows) as users_total, true as in_range""",
    "route_als": """
        select user_id, risk_mode, rank, source, token_id_int, score
        from (select q.*, case when h.user_id_int in (select user_id_int from train_rows) then 'als'
                               when q.risk_mode = 'safe' then 'safe' else 'trending' end as source
              from requests q left join (select distinct cast(user_id as varchar) as user_id, user_id_int
                                         from interactions) h using (user_id))
        join model_answers using (source)""",
    "recommend_for_user": """
        select user_id, risk_mode, rank, source, token_id_int, score
        from (select cast(min(user_id) as varchar) as user_id, 'safe' as risk_mode, 'als' as source
              from train_rows
              union all select '-2', 'safe', 'safe' union all select '-3', 'daring', 'trending')
        join model_answers using (source)""",
    "route_wallets": f"""
        select w.wallet, w.risk_mode, cast(r.rank as int) as rank, r.token_id_int, round(r.score, 6) as score, w.source
        from wallet_answers w join recs r on w.source = 'als' and r.user_id_int = w.user_id_int
        where r.rank <= {TOP_N}
        union all
        select w.wallet, w.risk_mode, cast(c.rank as int), c.token_id_int, round(c.score, 6), w.source
        from wallet_answers w join catalogs c on c.source = w.source""",
    "route_recommendations": f"""
        select user_id, risk_mode, cast(rank as int) as rank, token_id_int,
               round(score, 6) as score, source
        from (select q.user_id, q.risk_mode, r.rank, r.token_id_int, r.score, q.source
              from routed q join recs r on q.source = 'als' and r.user_id_int = q.user_id_int
              where r.rank <= {TOP_N}
              union all
              select q.user_id, q.risk_mode, c.rank, c.token_id_int, c.score, q.source
              from routed q join catalogs c on c.source = q.source)""",
}
STEPS["blocks"] = """
    select *, sum(users) over () as n, sum(users * tx_value) over () as t from curve"""

_WORD = re.compile(r"\b[a-z_0-9]+\b")


def _needed(sql: str) -> list[str]:
    """Steps used by ``sql``, each after the steps it uses itself."""
    found: list[str] = []

    def visit(text: str) -> None:
        for word in _WORD.findall(text):
            if word in STEPS and word not in found:
                visit(STEPS[word])
                if word not in found:
                    found.append(word)

    visit(sql)
    return found


def oracle_sql() -> dict[str, str]:
    """One SQL statement per query that SQL can express."""
    statements = {}
    for name, final in FINAL.items():
        steps = [f"{step} as materialized ({STEPS[step]})" for step in _needed(final)]
        statements[name] = f"with {', '.join(steps)} {final}"
    return statements
