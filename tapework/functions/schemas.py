"""The 20 market-event tables: their columns, types, and where in an event each column comes from.

A column is written name=KEY:RULE. KEY is the event's key (in a nested object behind a dot) and RULE how its value is read:
t a time in milliseconds, s a string, d a decimal, u and i integers, oi an integer that may be missing, b0 and b1 a boolean with its
default, j JSON text. rx is the receive time, src the source label, st the symbol type (st outside, else in the nested object), w the window in the event's type.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DECIMAL, UNSIGNED = T.DecimalType(38, 18), T.DecimalType(20, 0)
TYPES = {"t": T.TimestampType(), "rx": T.TimestampType(), "s": T.StringType(), "src": T.StringType(), "w": T.StringType(), "j": T.StringType(), "d": DECIMAL, "u": UNSIGNED, "i": T.LongType(), "oi": T.IntegerType(), "st": T.IntegerType(), "b0": T.BooleanType(), "b1": T.BooleanType(), "n": T.IntegerType()}

#: Rules (spot or futures), event types, columns.
SPECS = {
    "depth_updates": ("spot", "depthUpdate", "event_time=E:t received_at=rx symbol=s:s first_update_id=U:u final_update_id=u:u source=src bids=b:j asks=a:j"),
    "aggregate_trades": ("spot", "aggTrade", "event_time=E:t received_at=rx symbol=s:s aggregate_trade_id=a:u price=p:d quantity=q:d first_trade_id=f:u last_trade_id=l:u trade_time=T:t buyer_is_maker=m:b0 is_best_match=M:b1 source=src"),
    "trades": ("spot", "trade", "event_time=E:t received_at=rx symbol=s:s trade_id=t:u price=p:d quantity=q:d trade_time=T:t buyer_is_maker=m:b0 is_best_match=M:b1 source=src"),
    "book_tickers": ("spot", "", "received_at=rx symbol=s:s update_id=u:u bid_price=b:d bid_quantity=B:d ask_price=a:d ask_quantity=A:d source=src"),
    "tickers": ("spot", "24hrTicker", "event_time=E:t received_at=rx symbol=s:s price_change=p:d price_change_percent=P:d weighted_average_price=w:d previous_close_price=x:d last_price=c:d last_quantity=Q:d bid_price=b:d bid_quantity=B:d ask_price=a:d ask_quantity=A:d open_price=o:d high_price=h:d low_price=l:d base_volume=v:d quote_volume=q:d statistics_open_time=O:t statistics_close_time=C:t first_trade_id=F:i last_trade_id=L:i trade_count=n:u source=src"),
    "rolling_tickers": ("spot", "1hTicker 4hTicker 1dTicker", "event_time=E:t received_at=rx symbol=s:s window_size=w price_change=p:d price_change_percent=P:d open_price=o:d high_price=h:d low_price=l:d last_price=c:d weighted_average_price=w:d base_volume=v:d quote_volume=q:d statistics_open_time=O:t statistics_close_time=C:t first_trade_id=F:i last_trade_id=L:i trade_count=n:u source=src"),
    "mini_tickers": ("spot", "24hrMiniTicker", "event_time=E:t received_at=rx symbol=s:s close_price=c:d open_price=o:d high_price=h:d low_price=l:d base_volume=v:d quote_volume=q:d source=src"),
    "klines": ("spot", "kline", "event_time=E:t received_at=rx symbol=s:s kline_start_time=k.t:t kline_close_time=k.T:t kline_symbol=k.s:s interval=k.i:s first_trade_id=k.f:i last_trade_id=k.L:i open_price=k.o:d close_price=k.c:d high_price=k.h:d low_price=k.l:d base_volume=k.v:d trade_count=k.n:u is_closed=k.x:b0 quote_volume=k.q:d taker_buy_base_volume=k.V:d taker_buy_quote_volume=k.Q:d ignored=k.B:d source=src"),
    "average_prices": ("spot", "avgPrice", "event_time=E:t received_at=rx symbol=s:s interval=i:s average_price=w:d last_trade_time=T:t source=src"),
    "futures_depth_updates": ("futures", "depthUpdate", "event_time=E:t transaction_time=T:t received_at=rx symbol=s:s pair=ps:s first_update_id=U:u final_update_id=u:u previous_final_update_id=pu:u bids=b:j asks=a:j symbol_type=st source=src"),
    "futures_aggregate_trades": ("futures", "aggTrade", "event_time=E:t received_at=rx symbol=s:s pair=ps:s aggregate_trade_id=a:u price=p:d quantity=q:d normal_quantity=nq:d first_trade_id=f:u last_trade_id=l:u trade_time=T:t buyer_is_maker=m:b0 symbol_type=st source=src"),
    "futures_book_tickers": ("futures", "bookTicker", "event_time=E:t transaction_time=T:t received_at=rx symbol=s:s update_id=u:u bid_price=b:d bid_quantity=B:d ask_price=a:d ask_quantity=A:d pair=ps:s symbol_type=st source=src"),
    "futures_mark_prices": ("futures", "markPriceUpdate", "event_time=E:t received_at=rx symbol=s:s pair=ps:s mark_price=p:d index_price=i:d estimated_settle_price=P:d funding_rate=r:d next_funding_time=T:t symbol_type=st source=src"),
    "futures_liquidations": ("futures", "forceOrder", "event_time=E:t received_at=rx symbol=o.s:s side=o.S:s order_type=o.o:s time_in_force=o.f:s original_quantity=o.q:d price=o.p:d average_price=o.ap:d order_status=o.X:s last_filled_quantity=o.l:d accumulated_filled_quantity=o.z:d trade_time=o.T:t pair=o.ps:s symbol_type=st source=src"),
    "futures_mini_tickers": ("futures", "24hrMiniTicker", "event_time=E:t received_at=rx symbol=s:s pair=ps:s close_price=c:d open_price=o:d high_price=h:d low_price=l:d base_volume=v:d quote_volume=q:d symbol_type=st source=src"),
    "futures_tickers": ("futures", "24hrTicker", "event_time=E:t received_at=rx symbol=s:s pair=ps:s price_change=p:d price_change_percent=P:d weighted_average_price=w:d last_price=c:d last_quantity=Q:d open_price=o:d high_price=h:d low_price=l:d base_volume=v:d quote_volume=q:d statistics_open_time=O:t statistics_close_time=C:t first_trade_id=F:i last_trade_id=L:i trade_count=n:u symbol_type=st source=src"),
    "futures_klines": ("futures", "kline", "event_time=E:t received_at=rx symbol=s:s pair=k.ps:s kline_start_time=k.t:t kline_close_time=k.T:t interval=k.i:s first_trade_id=k.f:i last_trade_id=k.L:i open_price=k.o:d close_price=k.c:d high_price=k.h:d low_price=k.l:d base_volume=k.v:d trade_count=k.n:u is_closed=k.x:b0 quote_volume=k.q:d taker_buy_base_volume=k.V:d taker_buy_quote_volume=k.Q:d ignored=k.B:d symbol_type=st source=src"),
}
#: Tables that are not read from events of one type: book levels and open interest.
OTHERS = {
    "depth_levels": "event_time:t received_at:t symbol:s first_update_id:u final_update_id:u side:s level:n price:d quantity:d source:s",
    "futures_depth_levels": "event_time:t transaction_time:t received_at:t symbol:s pair:s first_update_id:u final_update_id:u previous_final_update_id:u side:s level:n price:d quantity:d source:s",
    "futures_open_interest": "observed_at:t received_at:t symbol:s pair:s contract_type:s open_interest:d source:s",
}


@dataclass(frozen=True)
class Column:
    name: str
    key: str
    rule: str

    @property
    def nested(self) -> str:
        """The key of the nested object, or an empty string."""
        return self.key.rpartition(".")[0]


@dataclass(frozen=True)
class Table:
    name: str
    rules: str
    events: tuple[str, ...]
    columns: tuple[Column, ...]

    @property
    def nested(self) -> str:
        return next((c.nested for c in self.columns if c.nested), "")


def _column(text: str) -> Column:
    name, _, rest = text.partition("=")
    key, _, rule = rest.rpartition(":")
    return Column(name, key, rule)


TABLES = {name: Table(name, rules, tuple(events.split()) or ("",), tuple(map(_column, columns.split()))) for name, (rules, events, columns) in SPECS.items()}


def _struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[rule], True) for name, rule in fields])


SCHEMAS: dict[str, T.StructType] = {t.name: _struct([(c.name, c.rule) for c in t.columns]) for t in TABLES.values()}
SCHEMAS |= {name: _struct([tuple(x.split(":")) for x in columns.split()]) for name, columns in OTHERS.items()}
RAW = "payload string, received_at timestamp, market string, shard_id int"
SNAPSHOT = "exchange string, market string, symbol string, captured_at timestamp, requested_at timestamp, last_update_id decimal(20,0), `limit` int, payload string"
