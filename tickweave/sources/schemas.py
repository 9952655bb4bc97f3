"""Schemas of the native inputs (DDL strings). Numbers inside feed payloads are strings and are coerced by projections."""

SNAPSHOT = "type STRING, source STRING, symbol STRING, time BIGINT, price STRING, features MAP<STRING, STRING>"
EVENT = "type STRING, time BIGINT, recvTime BIGINT, data STRING"
#: Payloads have names that differ in case only (b and B), so they are maps, whose keys are exact.
PAYLOAD = "MAP<STRING, STRING>"
LEVELS = "ARRAY<ARRAY<STRING>>"
BAR = "symbol STRING, openTime BIGINT, closeTime BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, quoteVolume DOUBLE, trades BIGINT, takerBuyBase DOUBLE, takerBuyQuote DOUBLE"
FUNDING = "symbol STRING, time BIGINT, fundingRate DOUBLE, nextFundingTime BIGINT"
OPEN_INTEREST = "symbol STRING, time BIGINT, openInterest DOUBLE"
