"""SQL that computes each query's result anew, for a DuckDB check."""

from __future__ import annotations

ARM = "/subscriptions/sub-1/resourceGroups/rg-1/providers/Microsoft.CognitiveServices/accounts/OpenAI-"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
INSIDE = "TIMESTAMP '2024-01-24 12:00:00'"
INSIDE_DAY = "TIMESTAMP '2024-01-24 00:00:00'"
DAY_BEFORE = "TIMESTAMP '2024-01-23 12:00:00'"
UNIT_COSTS = {"CostPerToken", "CostPerApiCall", "CostPerUnit", "avg_cost_per_token", "avg_cost_per_call"}

CTES: dict[str, str] = {}
NEEDS: dict[str, list[str]] = {}


def cte(name: str, needs: list[str], body: str) -> None:
    CTES[name], NEEDS[name] = body, needs


def sql(needs: list[str], select: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS[name]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    kept = {"kept_fact"}  # referred to twice and dear
    parts = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in kept else ''}({CTES[n]})" for n in order)
    return f"WITH {parts}\n{select}"


def r(expr: str, alias: str | None = None) -> str:
    # the nudge settles exact rounding ties alike, whatever the order of a sum
    nudge, places = ("3e-13", 9) if (alias or expr).strip('"') in UNIT_COSTS else ("3e-10", 6)
    return f"round(CAST({expr} AS DOUBLE) + {nudge}, {places}) AS {alias or expr}"


def before(time: str, as_of: str, span: str) -> str:
    return f"{time} >= {as_of} - INTERVAL {span} AND {time} < {as_of}"


def big(expr: str, alias: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias or expr}"


cte("calls", [], f"""
  SELECT event_id, user_id, event_type, ts AS TimeGenerated,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    'req-' || event_id AS RequestId,
    CASE WHEN user_id % 10 = 0 THEN 'unknown' ELSE 'device-' || user_id END AS deviceId,
    CASE WHEN user_id % 15 = 0 THEN 'unknown' ELSE 'store-' || (user_id % 12) END AS storeNumber,
    event_type AS ApiName, 'POST' AS Method,
    'https://openai-' || (user_id % 5) || '.openai.azure.com/openai' AS Url,
    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS StatusCode,
    floor(value * 10) AS ResponseTime,
    CASE WHEN event_type = 'signup' THEN 0
         ELSE 20 * CAST(json_extract(props, '$.k') AS BIGINT) END AS TokensUsed,
    CASE event_id % 3 WHEN 0 THEN '{ARM}' || (user_id % 5)
         WHEN 1 THEN 'https://openai-' || (user_id % 5) || '.openai.azure.com/openai'
         ELSE 'openai-' || (user_id % 5) END AS RawResource,
    'openai-' || (user_id % 5) AS ResourceId,
    'region-' || ((user_id % 5) % 3) AS Region,
    date_trunc('hour', ts) AS TimeWindow
  FROM events""")

METER = """CASE l_linenumber WHEN 1 THEN 'GPT-5 Input Tokens' WHEN 2 THEN 'GPT-5-Turbo Output Tokens'
    WHEN 3 THEN 'GPT-4o Input Tokens' WHEN 4 THEN 'gpt-4o-mini-0718-Outp-glbl Tokens'
    WHEN 5 THEN 'GPT-35-Turbo Output Tokens' WHEN 6 THEN 'PTU Provisioned'
    ELSE 'text-embedding-ada-002 Tokens' END"""


def billing_cte(date: str) -> str:
    return f"""
  SELECT UsageDate, '{ARM}' || res AS ResourceId, 'openai-' || res AS Resource, 'OpenAI-' || res AS ResourceName,
    'Microsoft.CognitiveServices/accounts' AS ResourceType,
    CASE WHEN l_linenumber <= 5 THEN 'Azure OpenAI' WHEN l_linenumber = 6 THEN 'Cognitive Services'
         ELSE 'Storage' END AS ServiceName,
    {METER} AS Meter, l_linenumber AS cost_seq, 'USD' AS Currency,
    CAST(amount AS DOUBLE) / 99991 AS PreTaxCost, CAST(quantity AS DOUBLE) AS UsageQuantity
  FROM (SELECT {date} AS UsageDate, l_suppkey % 5 AS res, l_linenumber,
          sum(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS amount,
          sum(CAST(l_quantity AS DECIMAL(12,2))) AS quantity
        FROM lineitem GROUP BY 1, 2, 3)"""


cte("billing", [], billing_cte(
    "TIMESTAMP '2024-01-01' + to_days(CAST(l_orderkey % 30 AS INTEGER)) + to_hours(CAST(l_partkey % 24 AS INTEGER))"))
cte("shipped", [], billing_cte("l_shipdate"))

CATEGORY = """
    CASE cost_seq WHEN 1 THEN 'Input Tokens' WHEN 2 THEN 'Output Tokens' WHEN 3 THEN 'Input Tokens'
         WHEN 5 THEN 'Output Tokens' WHEN 6 THEN 'Provisioned Throughput' ELSE 'Unknown' END AS CostType,
    CASE cost_seq WHEN 1 THEN 'Input' WHEN 2 THEN 'Output' WHEN 3 THEN 'Input' WHEN 5 THEN 'Output' END AS TokenType,
    CASE cost_seq WHEN 1 THEN 'GPT-5' WHEN 2 THEN 'GPT-5-Turbo' WHEN 3 THEN 'GPT-4o' WHEN 4 THEN 'GPT-4o'
         WHEN 5 THEN 'GPT-3.5-Turbo' WHEN 6 THEN 'Unknown' ELSE 'Ada' END AS ModelFamily,
    cost_seq IN (1, 2, 3, 5) AS IsTokenBased,
    CASE WHEN UsageQuantity > 0 THEN PreTaxCost / UsageQuantity ELSE 0 END AS CostPerUnit"""

cte("cost", ["billing"], f"""
  SELECT UsageDate, date_trunc('hour', UsageDate) AS TimeWindow, Resource AS ResourceId, ResourceName,
    'rg-1' AS ResourceGroup, Meter AS MeterName, cost_seq, Currency, PreTaxCost AS Cost, UsageQuantity, {CATEGORY}
  FROM billing WHERE ServiceName IN ('Azure OpenAI', 'Cognitive Services')""")

cte("usage", ["calls"], """
  SELECT TimeWindow, ResourceId, deviceId AS DeviceId, storeNumber AS StoreNumber,
    CAST(sum(TokensUsed) AS BIGINT) AS TokensUsed, count(*) AS ApiCalls, avg(ResponseTime) AS AvgResponseTime,
    sum(TokensUsed * exp(-(epoch_us(TimeWindow + INTERVAL 1 HOUR) - epoch_us(TimeGenerated)) / 3.6e9 / 2.0)) AS Weighted
  FROM calls GROUP BY ALL""")

cte("totals", ["usage"], """
  SELECT TimeWindow, ResourceId, CAST(sum(TokensUsed) AS BIGINT) AS tok, CAST(sum(ApiCalls) AS BIGINT) AS cal,
    count(*) AS n, sum(Weighted) AS wei
  FROM usage GROUP BY ALL""")

cte("matched", ["usage", "totals", "cost"], """
  SELECT u.*, t.tok, t.cal, t.n, t.wei, c.Cost, c.MeterName, c.CostType, c.ModelFamily, c.ResourceName,
    c.ResourceGroup, c.Currency, c.UsageQuantity
  FROM usage u JOIN totals t USING (TimeWindow, ResourceId) JOIN cost c USING (TimeWindow, ResourceId)""")

# All copies of a cell carry the first line; totals count every copy.
cte("matched_first", ["usage", "totals", "cost"], """
  SELECT u.*, t.tok * m.lines AS tok, t.cal * m.lines AS cal, t.n * m.lines AS n, t.wei * m.lines AS wei,
    f.Cost, f.MeterName, f.CostType, f.ModelFamily, f.ResourceName, f.ResourceGroup, f.Currency
  FROM usage u JOIN totals t USING (TimeWindow, ResourceId)
  JOIN (SELECT TimeWindow, ResourceId, count(*) AS lines, min(cost_seq) AS first_seq FROM cost GROUP BY ALL) m
    USING (TimeWindow, ResourceId)
  JOIN cost f ON f.TimeWindow = u.TimeWindow AND f.ResourceId = u.ResourceId AND f.cost_seq = m.first_seq
  JOIN cost c ON c.TimeWindow = u.TimeWindow AND c.ResourceId = u.ResourceId""")

ONE = "CAST(1 AS DOUBLE)"
SHARES = {
    "proportional": f"CASE WHEN tok > 0 THEN TokensUsed / tok ELSE {ONE} / n END",
    "token-based": f"CASE WHEN tok > 0 THEN TokensUsed / tok ELSE {ONE} / n END",
    "equal": f"{ONE} / n",
    "usage-based": f"CASE WHEN cal > 0 THEN ApiCalls / cal ELSE {ONE} / n END",
    "time-weighted": f"CASE WHEN wei > 0 THEN Weighted / wei ELSE {ONE} / n END",
}
FIRST_SHARES = {
    "proportional": f"CASE WHEN tok > 0 AND TokensUsed > 0 THEN TokensUsed / tok ELSE {ONE} / n END",
    "token-based": f"CASE WHEN tok > 0 AND TokensUsed > 0 THEN TokensUsed / tok ELSE {ONE} / n END",
    "equal": f"{ONE} / n",
    "usage-based": f"CASE WHEN cal > 0 AND ApiCalls > 0 THEN ApiCalls / cal ELSE {ONE} / n END",
    "time-weighted": f"CASE WHEN tok > 0 AND TokensUsed > 0 THEN TokensUsed / tok ELSE {ONE} / n END",
}
BASE_ACCURACY = {
    "proportional": "0.9",
    "token-based": "CASE WHEN TokensUsed > 0 THEN 0.95 ELSE 1.0 END",
    "usage-based": "0.8",
    "equal": "0.7",
    "time-weighted": "1.0",
}


def allocation(method: str, first: bool = False) -> str:
    share = (FIRST_SHARES if first else SHARES)[method]
    return f"CASE WHEN Cost > 0 THEN ({share}) * Cost ELSE 0 END"


def fact_cte(method: str, first: bool = False) -> str:
    source = "matched_first" if first else "matched"
    return f"""
  SELECT *, CASE WHEN TokensUsed > 0 THEN AllocatedCost / TokensUsed ELSE 0 END AS CostPerToken,
    CASE WHEN ApiCalls > 0 THEN AllocatedCost / ApiCalls ELSE 0 END AS CostPerApiCall,
    DeviceId = 'unknown' AS IsUnknownDevice, StoreNumber = 'unknown' AS IsUnknownStore,
    DeviceId <> 'unknown' AND StoreNumber <> 'unknown' AS HasCompleteAttribution,
    hour(TimeWindow) AS Hour, dayname(TimeWindow) AS DayOfWeek,
    hour(TimeWindow) >= 9 AND hour(TimeWindow) <= 17 AS IsBusinessHours,
    isodow(TimeWindow) <= 5 AS IsWeekday,
    CASE WHEN hour(TimeWindow) >= 6 AND hour(TimeWindow) < 14 THEN 'Morning'
         WHEN hour(TimeWindow) >= 14 AND hour(TimeWindow) < 22 THEN 'Evening' ELSE 'Night' END AS ShiftCategory,
    least(CAST(1 AS DOUBLE) * (CASE WHEN DeviceId = 'unknown' THEN 0.6 ELSE 1 END)
      * (CASE WHEN StoreNumber = 'unknown' THEN 0.8 ELSE 1 END) * (CASE WHEN TokensUsed = 0 THEN 0.5 ELSE 1 END)
      * (CASE WHEN DeviceId <> 'unknown' AND StoreNumber <> 'unknown' THEN 1.1 ELSE 1 END)
      * (CASE WHEN TokensUsed > 100 THEN 1.05 ELSE 1 END), 1.0) AS CorrelationConfidence,
    CAST({BASE_ACCURACY[method]} AS DOUBLE) * (CASE WHEN DeviceId = 'unknown' THEN 0.7 ELSE 1 END)
      * (CASE WHEN StoreNumber = 'unknown' THEN 0.9 ELSE 1 END) AS AllocationAccuracy,
    (least(ApiCalls / 10.0, 1.0) + least(TokensUsed / 1000.0, 1.0)) / 2.0 AS DeviceUtilizationScore
  FROM (SELECT TimeWindow, ResourceId, ResourceName, ResourceGroup, DeviceId, StoreNumber,
      DeviceId || '_' || StoreNumber AS DeviceStoreKey, {allocation(method, first)} AS AllocatedCost,
      Cost AS TotalCost, '{method}' AS AllocationMethod, TokensUsed, ApiCalls, AvgResponseTime, CostType,
      ModelFamily, MeterName, Currency,
      CASE WHEN tok > 0 THEN TokensUsed / tok ELSE 0 END AS TokenShare,
      CASE WHEN cal > 0 THEN ApiCalls / cal ELSE 0 END AS ApiCallShare,
      {AS_OF} AS CorrelationTimestamp, '2024-01-31' AS ProcessingDate
    FROM {source})"""


cte("fact", ["matched"], fact_cte("proportional"))
cte("fact_first", ["matched_first"], fact_cte("proportional", first=True))

FACT_COLUMNS = ", ".join([
    "TimeWindow", "ResourceId", "ResourceName", "ResourceGroup", "DeviceId", "StoreNumber", "DeviceStoreKey",
    r("AllocatedCost"), r("TotalCost"), "AllocationMethod", big("TokensUsed"), big("ApiCalls"), r("AvgResponseTime"),
    "CostType", "ModelFamily", "MeterName", "Currency", r("TokenShare"), r("ApiCallShare"), "CorrelationTimestamp",
    "ProcessingDate", "IsUnknownDevice", "IsUnknownStore", "HasCompleteAttribution", r("CostPerToken"),
    r("CostPerApiCall"), big("Hour"), "DayOfWeek", "IsBusinessHours", "IsWeekday", "ShiftCategory",
    r("CorrelationConfidence"), r("AllocationAccuracy"), r("DeviceUtilizationScore")])
KEY = "TimeWindow, ResourceId, MeterName, DeviceId, StoreNumber"

ORACLES: dict[str, str] = {}


def oracle(name: str, needs: list[str], select: str) -> None:
    ORACLES[name] = sql(needs, select)


# Sources ------------------------------------------------------------------

# Bodies that are not valid events: truncated, other type, a JSON array.
cte("valid_events", ["calls"], """
  SELECT *, CASE WHEN event_type = 'error' THEN 'FinOpsApiError' ELSE 'FinOpsApiCall' END AS eventType,
    TokensUsed // 4 AS promptTokens, TokensUsed - TokensUsed // 4 AS completionTokens,
    'gpt-' || (user_id % 3 + 3) AS model
  FROM calls WHERE event_id % 50 NOT IN (0, 1, 2)""")

oracle("src_events", ["valid_events"], f"""
  SELECT eventType, TimeGenerated AS "timestamp", RequestId AS correlationId, deviceId, storeNumber,
    ApiName AS operationName, {big('StatusCode', 'statusCode')}, {big('TokensUsed', 'tokensUsed')},
    {big('promptTokens')}, {big('completionTokens')}, model, Region AS resourceRegion, ResourceId AS resourceId,
    {r('ResponseTime', 'responseTime')}
  FROM valid_events""")
oracle("src_events_rejects", ["calls"], """
  SELECT CASE WHEN event_id % 50 = 1 THEN 'other event type' ELSE 'not a JSON object' END AS reason, count(*) AS n
  FROM calls WHERE event_id % 50 IN (0, 1, 2) GROUP BY 1""")
oracle("src_traces", ["valid_events"], f"""
  SELECT TimeGenerated, RequestId, deviceId, storeNumber, ApiName, Method, Url, {big('StatusCode')},
    {r('ResponseTime')}, {big('nullif(TokensUsed, 0)', 'TokensUsed')}, ResourceId
  FROM valid_events WHERE {before('TimeGenerated', INSIDE, '168 HOUR')}""")

GATEWAY_IDS = """
    CASE WHEN user_id % 10 <> 0 AND user_id % 4 = 0 THEN deviceId ELSE 'unknown' END AS deviceId,
    CASE WHEN user_id % 10 <> 0 AND user_id % 4 = 0 THEN storeNumber ELSE 'unknown' END AS storeNumber"""
GATEWAY_URL = """
    Url || CASE WHEN user_id % 10 <> 0 AND user_id % 4 = 2
                THEN '?api-version=1&device-id=' || deviceId || '&store-number=' || storeNumber
                WHEN user_id % 10 <> 0 AND user_id % 4 = 3
                THEN '?api-version=1&device_id=' || deviceId || '&store_number=' || storeNumber ELSE '' END"""
GATEWAY_RESOURCE = f"CASE WHEN event_id % 2 = 1 THEN Url ELSE '{ARM}' || (user_id % 5) END"
GATEWAY_WHERE = "event_id % 7 <> 0"
RECENT = before("TimeGenerated", INSIDE, "168 HOUR")

oracle("src_gateway_logs", ["calls"], f"""
  SELECT TimeGenerated, RequestId, {GATEWAY_IDS}, 'model-api' AS ApiName, ApiName AS OperationName, Method,
    {GATEWAY_URL} AS Url, {big('StatusCode')}, {r('ResponseTime')}, {r('floor(ResponseTime / 2)', 'BackendTime')},
    CAST(1 AS DOUBLE) AS ClientTime, {big('k + 100', 'RequestSize')}, {big('TokensUsed + 200', 'ResponseSize')},
    {big('TokensUsed')}, {GATEWAY_RESOURCE} AS ResourceId, Url AS BackendUrl
  FROM calls WHERE {GATEWAY_WHERE} AND {RECENT}""")
oracle("norm_gateway_record", ["calls"], f"""
  SELECT 'APIM' AS Source, TimeGenerated, RequestId, {GATEWAY_IDS}, 'model-api' AS ApiName, Method,
    {GATEWAY_URL} AS Url, {big('StatusCode')}, {r('ResponseTime')}, {big('TokensUsed')},
    {GATEWAY_RESOURCE} AS ResourceId
  FROM calls WHERE {GATEWAY_WHERE}""")

REQUEST_ROWS = f"""
    TimeGenerated, RequestId, deviceId, storeNumber, 'POST /OpenAI/' || ApiName AS ApiName, Method, Url,
    {big('StatusCode')}, {r('ResponseTime + 0.5', 'ResponseTime')}, {big('TokensUsed')}, ResourceId"""
REQUEST_WHERE = "event_id % 4 <> 0"
oracle("src_requests", ["calls"], f"SELECT {REQUEST_ROWS} FROM calls WHERE {REQUEST_WHERE} AND {RECENT}")
oracle("norm_request_record", ["calls"],
       f"SELECT 'ApplicationInsights' AS Source, {REQUEST_ROWS} FROM calls WHERE {REQUEST_WHERE}")

cte("daily_billing", ["billing"], """
  SELECT CAST(UsageDate AS DATE) AS UsageDate, ResourceId, Resource, ResourceType, ServiceName, Meter,
    sum(PreTaxCost) AS PreTaxCost, sum(UsageQuantity) AS UsageQuantity, min(Currency) AS Currency
  FROM billing WHERE ServiceName IN ('Azure OpenAI', 'Cognitive Services') GROUP BY ALL""")
oracle("src_cost_usage", ["daily_billing"], f"""
  SELECT CAST(UsageDate AS VARCHAR) AS UsageDate, ResourceId, ResourceType, ServiceName, Meter,
    {r('PreTaxCost')}, {r('UsageQuantity')}, Currency FROM daily_billing""")
oracle("src_cost_json", ["daily_billing"], f"""
  SELECT {r('PreTaxCost')}, {r('UsageQuantity')}, CAST(strftime(UsageDate, '%Y%m%d') AS BIGINT) AS UsageDate,
    ResourceId, ResourceType, ServiceName, Meter, Currency FROM daily_billing""")

for _name in ("read_partition", "correlated_fact", "stream_late_cost"):
    oracle(_name, ["fact"], f"SELECT {FACT_COLUMNS} FROM fact")
oracle("correlated_fact_reference", ["fact_first"], f"SELECT {FACT_COLUMNS} FROM fact_first")
oracle("combine_files", ["fact"], f"""
  SELECT DeviceId, StoreNumber, {r('AllocatedCost')}, {big('TokensUsed')}, {big('ApiCalls')}, TimeWindow,
    ModelFamily, CostType, ShiftCategory, IsBusinessHours FROM fact""")

# Two runs, at 12:00 and 12:30, with a lookback of six hours and bills at minute 45.
for _name in ("combine_overlapping_runs", "read_overlapping_windows"):
    oracle(_name, ["fact"], f"""
  SELECT {KEY}, {r('AllocatedCost')} FROM fact
  WHERE TimeWindow >= TIMESTAMP '2024-01-24 06:00:00' AND TimeWindow < {INSIDE}""")
ORACLES["run_owners"] = """
  SELECT RunKey, count(*) AS n_windows, min(w) AS FirstWindow, max(w) AS LastWindow
  FROM (SELECT w, CASE WHEN w >= TIMESTAMP '2024-01-20' THEN '20240131001200' WHEN w >= TIMESTAMP '2024-01-10' THEN '20240131000600'
          ELSE '20240131000000' END AS RunKey
        FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-24 23:00:00', INTERVAL 1 HOUR)) AS w))
  GROUP BY RunKey"""

DEVICE_SUMMARY = f"""
  SELECT DeviceId, StoreNumber, {r('sum(AllocatedCost)', 'TotalCost')}, count(*) AS RecordCount,
    {big('sum(TokensUsed)', 'TotalTokens')}, {big('sum(ApiCalls)', 'TotalApiCalls')},
    {r('avg(AvgResponseTime)', 'AvgResponseTime')}, {r('avg(DeviceUtilizationScore)', 'AvgUtilization')}"""
STORE_SUMMARY = f"""
  SELECT StoreNumber, {r('sum(AllocatedCost)', 'TotalCost')}, count(*) AS RecordCount,
    {big('sum(TokensUsed)', 'TotalTokens')}, {big('sum(ApiCalls)', 'TotalApiCalls')},
    count(DISTINCT DeviceId) AS UniqueDevices"""
oracle("device_summary", ["fact"], DEVICE_SUMMARY + " FROM fact GROUP BY DeviceId, StoreNumber")
oracle("store_summary", ["fact"], STORE_SUMMARY + " FROM fact GROUP BY StoreNumber")
oracle("read_summaries", ["fact"],
       DEVICE_SUMMARY + ", '2024-01-31' AS ProcessingDate FROM fact GROUP BY DeviceId, StoreNumber")
oracle("write_summaries", ["fact"], STORE_SUMMARY + ", '2024-01-31' AS ProcessingDate FROM fact GROUP BY StoreNumber")

# Cleansing ----------------------------------------------------------------

CLEAN = f"""
    TimeGenerated, RequestId, deviceId, storeNumber, ApiName, Method, Url, {big('StatusCode')}, {r('ResponseTime')},
    {big('TokensUsed')}, ResourceId, deviceId || '_' || storeNumber AS DeviceStoreKey,
    {big('hour(TimeGenerated)', 'HourOfDay')}, dayname(TimeGenerated) AS DayOfWeek"""
oracle("lookback_filter", ["calls"],
       f"SELECT {CLEAN} FROM calls WHERE {before('TimeGenerated', INSIDE, '36 HOUR')}")
oracle("preprocess_telemetry", ["calls"], f"SELECT {CLEAN}, TimeWindow FROM calls")
oracle("preprocess_cost", ["cost"], f"""
  SELECT UsageDate, TimeWindow, ResourceId, MeterName, {r('Cost')}, {r('UsageQuantity')}, {r('CostPerUnit')} FROM cost""")
oracle("preprocess_cost_daily", ["daily_billing"], f"""
  SELECT CAST(UsageDate AS TIMESTAMP) AS UsageDate, CAST(UsageDate AS TIMESTAMP) AS TimeWindow,
    Resource AS ResourceId, Meter AS MeterName, {r('PreTaxCost', 'Cost')} FROM daily_billing""")
oracle("normalize_resource_id", ["calls"],
       "SELECT RawResource AS ResourceId, ResourceId AS Normalized, count(*) AS n FROM calls GROUP BY ALL")
oracle("categorize_cost", ["billing"], f"""
  SELECT UsageDate, ResourceId, MeterName, CostType, TokenType, ModelFamily, IsTokenBased, {r('CostPerUnit')}
  FROM (SELECT *, Meter AS MeterName, {CATEGORY} FROM billing)""")
oracle("categorize_cost_extended", ["billing"], f"""
  SELECT MeterName, CostType, TokenType, TokenType IS NOT NULL AS IsTokenBased, {r('sum(PreTaxCost)', 'Cost')}
  FROM (SELECT PreTaxCost, MeterName,
          CASE WHEN cost_seq = 4 THEN 'Output Tokens' ELSE CostType END AS CostType,
          CASE WHEN cost_seq = 4 THEN 'Output' ELSE TokenType END AS TokenType
        FROM (SELECT *, Meter AS MeterName, {CATEGORY} FROM billing)) GROUP BY ALL""")
oracle("normalize_cost", ["billing"], f"""
  SELECT ResourceId, ResourceType, ServiceName, Meter AS MeterName, UsageDate, {r('PreTaxCost', 'Cost')},
    {r('UsageQuantity')}, Currency, '' AS BillingPeriod, 'sub-1' AS SubscriptionId, 'rg-1' AS ResourceGroup,
    ResourceName, {big('cost_seq')}, CostType, TokenType, ModelFamily, IsTokenBased, {r('CostPerUnit')}
  FROM (SELECT *, {CATEGORY} FROM billing)""")

BILLING_ROWS = f"""SELECT {r('PreTaxCost')}, {r('UsageQuantity')}, UsageDate, ResourceId, ResourceType, ServiceName,
    Meter, Currency, {big('cost_seq')} FROM billing"""
oracle("filter_costs_by_resources", ["billing"],
       BILLING_ROWS + f" WHERE ResourceId IN ('{ARM}1', '{ARM}3')")
oracle("filter_costs_by_resource_table", ["billing", "calls"],
       BILLING_ROWS + " WHERE Resource IN (SELECT ResourceId FROM calls WHERE event_type = 'error' AND Region = 'region-1')")
oracle("drop_empty_dims", ["valid_events"], """
  SELECT CAST(14 + CASE WHEN deviceId <> 'unknown' THEN 1 ELSE 0 END + CASE WHEN storeNumber <> 'unknown' THEN 1 ELSE 0 END
      + CASE WHEN TokensUsed <> 0 THEN 1 ELSE 0 END + CASE WHEN promptTokens <> 0 THEN 1 ELSE 0 END
      + CASE WHEN completionTokens <> 0 THEN 1 ELSE 0 END - 1 AS BIGINT) AS n_dimensions,
    RequestId AS correlation_id, nullif(deviceId, 'unknown') AS device_id, nullif(storeNumber, 'unknown') AS store_number,
    CAST(nullif(TokensUsed, 0) AS VARCHAR) AS tokens_used, model, CAST(NULL AS VARCHAR) AS product_id
  FROM valid_events""")
oracle("known_only", ["fact"],
       f"SELECT {FACT_COLUMNS} FROM fact WHERE DeviceId <> 'unknown' AND StoreNumber <> 'unknown'")
ROW = f"SELECT {KEY}, {r('AllocatedCost')} FROM fact"
oracle("row_level_security_store", ["fact"], ROW + " WHERE StoreNumber = 'store-3'")
oracle("row_level_security", ["fact"], ROW + """
  WHERE DeviceId IN (SELECT CASE WHEN user_id % 10 = 0 THEN 'unknown' ELSE 'device-' || user_id END
                     FROM events WHERE user_id % 7 = 2)""")
oracle("add_period_columns", ["fact"], f"""
  SELECT {KEY}, {r('CASE WHEN TokensUsed <> 0 THEN AllocatedCost / TokensUsed END', 'CostPerToken')},
    CAST(CAST(date_trunc('month', TimeWindow) AS DATE) AS VARCHAR) AS "Month",
    CAST(CAST(TimeWindow AS DATE) - CAST(dayofweek(TimeWindow) AS INTEGER) AS VARCHAR) AS "Week"
  FROM fact""")
oracle("incremental_range", ["fact"],
       ROW + " WHERE TimeWindow >= TIMESTAMP '2024-01-08' AND TimeWindow < TIMESTAMP '2024-01-15'")
ORACLES["incremental_range_recomputed"] = ORACLES["incremental_range"]
oracle("incremental_refresh", ["fact"],
       ROW + f" WHERE {before('TimeWindow', INSIDE_DAY, '7 DAY')}")
oracle("attribute_fallback", ["calls"], """
  SELECT RequestId AS CorrelationId, CASE WHEN user_id % 10 = 0 THEN 'unknown' ELSE deviceId END AS deviceId,
    CASE WHEN user_id % 10 = 0 THEN 'unknown' ELSE storeNumber END AS storeNumber FROM calls""")
oracle("extract_token_usage", ["calls"], f"""
  SELECT RequestId AS CorrelationId, {big("CASE WHEN event_type = 'error' THEN 0 ELSE TokensUsed END", 'tokensUsed')},
    {big("CASE WHEN event_type = 'error' THEN 0 ELSE TokensUsed // 4 END", 'promptTokens')},
    {big("CASE WHEN event_type = 'error' THEN 0 ELSE TokensUsed - TokensUsed // 4 END", 'completionTokens')},
    CASE WHEN event_id % 11 <> 0 THEN 'gpt-' || (user_id % 3 + 3) ELSE 'unknown' END AS model
  FROM calls""")
oracle("extract_backend_resource", ["calls"], """
  SELECT RequestId AS CorrelationId, CASE WHEN event_id % 5 = 0 THEN 'unknown' ELSE ResourceId END AS resourceId
  FROM calls""")

# Union and duplicates -----------------------------------------------------

SOURCE_COLUMNS = f"""TimeGenerated, RequestId, deviceId, storeNumber, ApiName, Method, Url, {big('StatusCode')},
    {r('ResponseTime')}, {big('TokensUsed')}, RawResource AS ResourceId"""
oracle("union_telemetry", ["calls"], f"""
  SELECT 'APIM' AS Source, {SOURCE_COLUMNS} FROM calls WHERE event_id % 2 = 0
  UNION ALL
  SELECT 'ApplicationInsights' AS Source, {SOURCE_COLUMNS} FROM calls WHERE event_id % 2 = 1 OR event_id % 20 = 0""")
oracle("dedup_telemetry", ["calls"], f"""
  SELECT CASE WHEN event_id % 2 = 0 THEN 'APIM' ELSE 'ApplicationInsights' END AS Source, {SOURCE_COLUMNS} FROM calls""")
oracle("duplicate_check", ["calls"],
       "SELECT RequestId, TimeGenerated, CAST(2 AS BIGINT) AS Copies FROM calls WHERE event_id % 20 = 0")

# Joins and allocation -----------------------------------------------------

oracle("correlate_time_window", ["matched"], f"""
  SELECT TimeWindow, ResourceId, DeviceId, StoreNumber, {big('TokensUsed')}, {big('ApiCalls')},
    {r('AvgResponseTime')}, MeterName, CostType, ModelFamily, ResourceName, ResourceGroup, Currency, {r('Cost')},
    {r('UsageQuantity')} FROM matched""")


def weighted(decay: str) -> str:
    def weight(ts: str) -> str:
        return f"exp(-(epoch_us({AS_OF}) - epoch_us({ts})) / 3.6e9 / {decay})"

    return f"""
  wu AS (SELECT deviceId, storeNumber, sum(TokensUsed * {weight('TimeGenerated')}) AS WeightedTokens,
      count(*) * sum({weight('TimeGenerated')}) AS WeightedApiCalls, sum({weight('TimeGenerated')}) AS TotalWeight,
      max(TimeGenerated) AS LatestTime FROM calls GROUP BY ALL),
  wr AS (SELECT deviceId, storeNumber, ResourceId, sum(TokensUsed * {weight('TimeGenerated')}) AS WeightedTokens,
      count(*) * sum({weight('TimeGenerated')}) AS WeightedApiCalls, sum({weight('TimeGenerated')}) AS TotalWeight,
      max(TimeGenerated) AS LatestTime FROM calls GROUP BY ALL),
  wc AS (SELECT ResourceId, sum(Cost * {weight('UsageDate')}) AS WeightedCost,
      sum(UsageQuantity * {weight('UsageDate')}) AS WeightedUsage, sum({weight('UsageDate')}) AS TotalWeight,
      max(UsageDate) AS LatestTime FROM cost GROUP BY ALL)"""


def with_weighted(decay: str, select: str) -> str:
    return sql(["calls", "cost"], "").rstrip() + ",\n" + weighted(decay) + select


MERGED = f"""
  SELECT deviceId, storeNumber, {r('WeightedTokens')}, {r('WeightedApiCalls')},
    {r('wr.TotalWeight', 'TotalWeight_telemetry')}, wr.LatestTime AS LatestTime_telemetry,
    date_trunc('hour', wr.LatestTime) AS TimeWindow, wr.ResourceId, {r('WeightedCost')}, {r('WeightedUsage')},
    {r('wc.TotalWeight', 'TotalWeight_cost')}, wc.LatestTime AS LatestTime_cost
  FROM wr JOIN wc ON wr.ResourceId = wc.ResourceId AND date_trunc('hour', wr.LatestTime) = date_trunc('hour', wc.LatestTime)"""
ORACLES["weighted_merge"] = with_weighted("72.0", MERGED)
ORACLES["time_weighted_correlation"] = with_weighted("2.0", MERGED)
ORACLES["weighted_usage"] = with_weighted("72.0", f"""
  SELECT deviceId, storeNumber, {r('WeightedTokens')}, {r('WeightedApiCalls')}, {r('TotalWeight')}, LatestTime FROM wu""")
ORACLES["weighted_cost"] = with_weighted("72.0", f"""
  SELECT ResourceId, {r('WeightedCost')}, {r('WeightedUsage')}, {r('TotalWeight')}, LatestTime FROM wc""")

oracle("uncorrelated_rows", ["totals", "cost"], f"""
  SELECT TimeWindow, ResourceId, 'usage without cost' AS Side, {big('tok', 'TokensUsed')}, {big('cal', 'ApiCalls')},
    CAST(0 AS DOUBLE) AS Cost
  FROM totals t WHERE NOT EXISTS (SELECT 1 FROM cost c WHERE c.TimeWindow = t.TimeWindow AND c.ResourceId = t.ResourceId)
  UNION ALL
  SELECT TimeWindow, ResourceId, 'cost without usage' AS Side, CAST(0 AS BIGINT), CAST(0 AS BIGINT),
    round(sum(Cost) + 3e-10, 6)
  FROM cost c WHERE NOT EXISTS (SELECT 1 FROM totals t WHERE c.TimeWindow = t.TimeWindow AND c.ResourceId = t.ResourceId)
  GROUP BY TimeWindow, ResourceId""")
oracle("star_join", ["fact"], f"""
  SELECT f.TimeWindow, f.ResourceId, f.MeterName, f.DeviceId, f.StoreNumber, {r('f.AllocatedCost', 'AllocatedCost')},
    dayname(f.TimeWindow) AS WeekdayName, 'Q' || quarter(f.TimeWindow) AS Quarter,
    isodow(f.TimeWindow) <= 5 AS IsBusinessDay, {r('d.DeviceCost', 'DeviceCost')}, d.HomeStore,
    {r('s.StoreCost', 'StoreCost')}, s.UniqueDevices
  FROM fact f
  JOIN (SELECT DeviceId, sum(AllocatedCost) AS DeviceCost,
          arg_min(StoreNumber, (TimeWindow, StoreNumber)) AS HomeStore FROM fact GROUP BY 1) d ON d.DeviceId = f.DeviceId
  JOIN (SELECT StoreNumber, sum(AllocatedCost) AS StoreCost, count(DISTINCT DeviceId) AS UniqueDevices
        FROM fact GROUP BY 1) s ON s.StoreNumber = f.StoreNumber""")

for _method, _key in {
    "proportional": "alloc_proportional", "token-based": "alloc_token_based", "equal": "alloc_equal",
    "usage-based": "alloc_usage_based", "time-weighted": "alloc_time_weighted",
}.items():
    for _first in (False, True):
        _source = "matched_first" if _first else "matched"
        oracle(_key + ("_reference" if _first else ""), [_source], f"""
  SELECT TimeWindow, ResourceId, MeterName, DeviceId, StoreNumber, {r(allocation(_method, _first), 'AllocatedCost')},
    {r('Cost', 'TotalCost')}, '{_method}' AS AllocationMethod,
    {r('CASE WHEN tok > 0 THEN TokensUsed / tok ELSE 0 END', 'TokenShare')},
    {r('CASE WHEN cal > 0 THEN ApiCalls / cal ELSE 0 END', 'ApiCallShare')}
  FROM {_source}""")

oracle("alloc_dispatch", ["matched", "matched_first"], "\nUNION ALL\n".join(
    f"SELECT '{m}' AS \"Method\", '{'reference' if first else 'conserving'}' AS \"Mode\", ResourceId, "
    f"{r(f'sum({allocation(m, first)})', 'AllocatedCost')} FROM {'matched_first' if first else 'matched'} GROUP BY ResourceId"
    for m in SHARES for first in (False, True)))
oracle("alloc_exact", ["usage", "cost"], """
  SELECT TimeWindow, ResourceId, MeterName, units AS BilledUnits, CASE WHEN n > 0 THEN units ELSE 0 END AS AllocatedUnits,
    coalesce(n, 0) AS Cells, CASE WHEN n > 0 THEN 0 ELSE units END AS UnallocatedUnits, true AS IsExact
  FROM (SELECT TimeWindow, ResourceId, MeterName, CAST(greatest(round(sum(Cost) * 1000000), 0) AS BIGINT) AS units FROM cost GROUP BY ALL)
  LEFT JOIN (SELECT TimeWindow, ResourceId, count(*) AS n FROM usage GROUP BY ALL) USING (TimeWindow, ResourceId)""")
oracle("enrich_fact", ["fact"], f"""
  SELECT {KEY}, IsUnknownDevice, IsUnknownStore, HasCompleteAttribution, {r('CostPerToken')}, {r('CostPerApiCall')},
    {big('Hour')}, DayOfWeek, IsBusinessHours, IsWeekday, ShiftCategory, CorrelationTimestamp, ProcessingDate
  FROM fact""")
oracle("score_confidence", ["fact"], f"SELECT {KEY}, {r('CorrelationConfidence')} FROM fact")
oracle("score_utilization", ["fact"], f"SELECT {KEY}, {r('DeviceUtilizationScore')} FROM fact")
oracle("score_accuracy", ["matched"], "\nUNION ALL\n".join(
    f"""SELECT '{m}' AS AllocationMethod, DeviceId = 'unknown' AS IsUnknownDevice, StoreNumber = 'unknown' AS IsUnknownStore,
    {r(f"CAST({b} AS DOUBLE) * (CASE WHEN DeviceId = 'unknown' THEN 0.7 ELSE 1 END) * (CASE WHEN StoreNumber = 'unknown' THEN 0.9 ELSE 1 END)", 'AllocationAccuracy')},
    count(*) AS n FROM matched GROUP BY 1, 2, 3, 4""" for m, b in BASE_ACCURACY.items()))
cte("reconciled", ["fact", "cost"], """
  SELECT TimeWindow, ResourceId, MeterName, o, coalesce(a, 0) AS a, CASE WHEN a IS NULL THEN o ELSE 0 END AS u
  FROM (SELECT TimeWindow, ResourceId, MeterName, sum(Cost) AS o FROM cost GROUP BY ALL)
  LEFT JOIN (SELECT TimeWindow, ResourceId, MeterName, sum(AllocatedCost) AS a FROM fact GROUP BY ALL)
    USING (TimeWindow, ResourceId, MeterName)""")
RECONCILED = f"""{r('o', 'OriginalCost')}, {r('a', 'AllocatedCost')}, {r('u', 'UnallocatedCost')},
    {r('CASE WHEN o <> 0 THEN abs(o - a) / o END', 'Variance')}, abs(o - a) <= 0.01 * abs(o) AS IsValid"""
oracle("reconcile_allocation", ["reconciled"], f"SELECT TimeWindow, ResourceId, MeterName, {RECONCILED} FROM reconciled")
oracle("reconcile_total", ["reconciled"],
       f"SELECT {RECONCILED} FROM (SELECT sum(o) AS o, sum(a) AS a, sum(u) AS u FROM reconciled)")

RULES = {
    "DeviceId present": "DeviceId IS NULL OR DeviceId = ''",
    "StoreNumber present": "StoreNumber IS NULL OR StoreNumber = ''",
    "ResourceId present": "ResourceId IS NULL OR ResourceId = ''",
    "TimeWindow present": "TimeWindow IS NULL",
    "AllocatedCost present": "AllocatedCost IS NULL",
    "AllocatedCost not negative": "AllocatedCost < 0",
    "TokensUsed not negative": "TokensUsed < 0",
    "ApiCalls not negative": "ApiCalls < 0",
    "CorrelationConfidence between 0 and 1": "NOT (CorrelationConfidence >= 0 AND CorrelationConfidence <= 1)",
    "AllocationAccuracy between 0 and 1": "NOT (AllocationAccuracy >= 0 AND AllocationAccuracy <= 1)",
    "DeviceUtilizationScore between 0 and 1": "NOT (DeviceUtilizationScore >= 0 AND DeviceUtilizationScore <= 1)",
    "DeviceId known": "DeviceId = 'unknown'",
    "StoreNumber known": "StoreNumber = 'unknown'",
}
oracle("dq_rules", ["fact"], "\nUNION ALL\n".join(
    f"SELECT count(*) AS RowsChecked, '{name}' AS \"Rule\", CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS Violations FROM fact"
    for name, cond in RULES.items()))

oracle("unreadable_numbers", ["valid_events"], "\nUNION ALL\n".join(
    f"SELECT count(*) AS RowsChecked, '{c}' AS \"Column\", CAST(0 AS BIGINT) AS Unreadable FROM valid_events"
    for c in ("statusCode", "tokensUsed", "promptTokens", "completionTokens", "responseTime")))

# Aggregations -------------------------------------------------------------

USAGE_ROWS = f"""TimeWindow, ResourceId, DeviceId, StoreNumber, {big('TokensUsed')}, {big('ApiCalls')},
    {r('AvgResponseTime')}"""
oracle("usage_by_window", ["usage"], f"SELECT {USAGE_ROWS} FROM usage")
oracle("telemetry_summary", ["calls"], f"""
  SELECT count(*) AS total_records, count(DISTINCT deviceId) AS unique_users, count(DISTINCT storeNumber) AS unique_stores,
    count(*) AS total_api_calls, {r('avg(ResponseTime)', 'avg_response_time')}, {big('sum(TokensUsed)', 'total_tokens')},
    {r('100.0 * count(*) FILTER (WHERE StatusCode < 400) / count(*)', 'success_rate')},
    min(TimeGenerated) AS start_time, max(TimeGenerated) AS end_time FROM calls""")
oracle("cost_summary", ["cost"], "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS dimension, {value} AS value, {r('sum(Cost)', 'total_cost')}, {r('sum(UsageQuantity)', 'total_usage')},
    count(DISTINCT ResourceId) AS unique_resources, min(UsageDate) AS start_date, max(UsageDate) AS end_date
    FROM cost GROUP BY {value}"""
    for name, value in (("cost_type", "CostType"), ("model_family", "ModelFamily"))) + f"""
    UNION ALL SELECT 'total', 'all', round(sum(Cost) + 3e-10, 6), round(sum(UsageQuantity) + 3e-10, 6), count(DISTINCT ResourceId),
      min(UsageDate), max(UsageDate) FROM cost""")
oracle("correlation_summary", ["fact"], f"""
  SELECT count(*) AS total_records, {r('sum(AllocatedCost)', 'total_allocated_cost')},
    count(DISTINCT DeviceId) AS unique_devices, count(DISTINCT StoreNumber) AS unique_stores,
    count(DISTINCT DeviceStoreKey) AS unique_device_store_combinations,
    {r('100.0 * count(*) FILTER (WHERE IsUnknownDevice) / count(*)', 'unknown_device_percentage')},
    {r('100.0 * count(*) FILTER (WHERE IsUnknownStore) / count(*)', 'unknown_store_percentage')},
    {r('avg(CorrelationConfidence)', 'avg_confidence')}, {r('avg(AllocationAccuracy)', 'avg_accuracy')},
    {r('avg(DeviceUtilizationScore)', 'avg_utilization_score')}, 'proportional' AS allocation_method
  FROM fact""")
oracle("cost_breakdowns", ["fact"], "\nUNION ALL\n".join(
    f"SELECT '{n}' AS dimension, {c} AS value, {r('sum(AllocatedCost)', 'cost')} FROM fact GROUP BY {c}"
    for n, c in (("device", "DeviceId"), ("store", "StoreNumber"), ("model", "ModelFamily"), ("shift", "ShiftCategory"))))
PERFORMANCE = f"""
    {r('sum(AllocatedCost)', 'AllocatedCost_sum')}, {r('avg(AllocatedCost)', 'AllocatedCost_mean')},
    count(AllocatedCost) AS AllocatedCost_count, {big('sum(TokensUsed)', 'TokensUsed_sum')},
    {r('avg(TokensUsed)', 'TokensUsed_mean')}, {big('sum(ApiCalls)', 'ApiCalls_sum')}, {r('avg(ApiCalls)', 'ApiCalls_mean')},
    {r('avg(DeviceUtilizationScore)', 'DeviceUtilizationScore_mean')}"""
oracle("device_performance", ["fact"], f"""
  SELECT DeviceId, {PERFORMANCE}, {r('avg(AvgResponseTime)', 'AvgResponseTime_mean')},
    arg_min(StoreNumber, (TimeWindow, StoreNumber)) AS StoreNumber_first FROM fact GROUP BY DeviceId""")
oracle("store_performance", ["fact"], f"""
  SELECT StoreNumber, {PERFORMANCE}, count(DISTINCT DeviceId) AS DeviceId_nunique FROM fact GROUP BY StoreNumber""")
oracle("shift_analysis", ["fact"],
       f"SELECT ShiftCategory, {r('sum(AllocatedCost)', 'AllocatedCost')} FROM fact GROUP BY 1")
oracle("business_hours_split", ["fact"], f"""
  SELECT {r('sum(CASE WHEN IsBusinessHours THEN AllocatedCost ELSE 0 END)', 'business_hours')},
    {r('sum(CASE WHEN IsBusinessHours THEN 0 ELSE AllocatedCost END)', 'non_business_hours')} FROM fact""")


def run_stats(calls_where: str, cost_where: str) -> str:
    return f"""
  SELECT (SELECT count(DISTINCT deviceId) FROM calls {calls_where}) AS unique_users,
    (SELECT count(DISTINCT storeNumber) FROM calls {calls_where}) AS unique_stores,
    (SELECT count(*) FROM calls {calls_where}) AS total_api_calls,
    {r(f'(SELECT sum(Cost) FROM cost {cost_where})', 'total_cost')},
    (SELECT count(DISTINCT ResourceId) FROM cost {cost_where}) AS unique_resources,
    {r('(SELECT sum(AllocatedCost) FROM run_fact)', 'allocated_cost')}, (SELECT count(*) FROM run_fact) AS records"""


cte("run_fact", ["fact"], "SELECT * FROM fact")
oracle("run_stats", ["run_fact", "calls", "cost"], run_stats("", ""))
oracle("api_usage_analysis", ["calls"], f"""
  SELECT deviceId, storeNumber, ApiName, count(*) AS TotalCalls, {r('avg(ResponseTime)', 'AvgResponseTime')},
    {big('sum(TokensUsed)', 'TotalTokens')},
    {r('100.0 * count(*) FILTER (WHERE StatusCode < 400) / count(*)', 'SuccessRate')}
  FROM calls WHERE {before('TimeGenerated', INSIDE, '1 DAY')} GROUP BY deviceId, storeNumber, ApiName""")
oracle("cost_by_user_store_day", ["fact"], f"""
  SELECT DeviceId, StoreNumber, CAST(CAST(TimeWindow AS DATE) AS VARCHAR) AS "Date",
    {r('sum(AllocatedCost)', 'TotalAllocatedCost')}, {r('avg(AllocatedCost)', 'AvgDailyCost')}
  FROM fact WHERE {before('TimeWindow', INSIDE, '7 DAY')} GROUP BY 1, 2, 3""")
oracle("model_usage_hourly", ["fact"], f"""
  SELECT ModelFamily, TimeWindow AS HourStart, {r('sum(AllocatedCost)', 'TotalCost')},
    {big('sum(TokensUsed)', 'TotalTokens')}, count(DISTINCT DeviceId) AS UniqueDevices
  FROM fact WHERE ModelFamily LIKE 'GPT-5%' GROUP BY 1, 2""")
oracle("resource_health", ["valid_events"], f"""
  SELECT count(*) AS TotalCalls, count(*) AS ValidResourceCalls, CAST(0 AS BIGINT) AS UnknownResourceCalls,
    CAST(100 AS DOUBLE) AS HealthScore, 'Healthy' AS Status
  FROM valid_events WHERE {before('TimeGenerated', INSIDE, '24 HOUR')} AND ResourceId <> 'unknown'""")
oracle("resource_time_coverage", ["calls"], """
  SELECT RawResource AS ResourceId, count(*) AS Calls, min(TimeGenerated) AS MinTime, max(TimeGenerated) AS MaxTime
  FROM calls GROUP BY 1""")
oracle("trace_rate_5m", ["calls"], """
  SELECT time_bucket(INTERVAL 5 MINUTE, TimeGenerated) AS WindowStart, count(*) AS Events FROM calls GROUP BY 1""")
oracle("throttle_hits_10m", ["calls"], """
  SELECT time_bucket(INTERVAL 10 MINUTE, TimeGenerated) AS WindowStart, count(*) AS RateLimitHits
  FROM calls WHERE k % 10 IN (0, 1) OR RequestId LIKE '%429%' GROUP BY 1""")
ROLE = "CASE WHEN event_id % 2 = 0 THEN 'forwarder' ELSE 'collector' END"
oracle("invocation_outcomes", ["calls"], f"""
  SELECT {ROLE} AS AppRoleName, count(*) AS Invocations, count(*) FILTER (WHERE event_type <> 'error') AS Successes,
    count(*) FILTER (WHERE event_type = 'error') AS Failures FROM calls GROUP BY 1""")
oracle("error_count", ["calls"],
       f"SELECT {ROLE} AS AppRoleName, count(*) AS Errors FROM calls WHERE event_type = 'error' GROUP BY 1")
oracle("date_hierarchy_rollup", ["shipped"], f"""
  SELECT {big('y', '"Year"')}, {big('q', '"Quarter"')}, {big('m', '"Month"')}, {big('d', '"Day"')},
    {r('sum(PreTaxCost)', 'Cost')}, {big('grouping(y, q, m, d)', '"Level"')}
  FROM (SELECT year(UsageDate) AS y, quarter(UsageDate) AS q, month(UsageDate) AS m, day(UsageDate) AS d, PreTaxCost FROM shipped)
  GROUP BY ROLLUP (y, q, m, d)""")
oracle("store_hierarchy_rollup", ["fact", "calls"], f"""
  SELECT Region, StoreNumber, {r('sum(AllocatedCost)', 'Cost')}, {big('sum(TokensUsed)', 'Tokens')},
    {big('grouping(Region, StoreNumber)', '"Level"')}
  FROM fact JOIN (SELECT DISTINCT ResourceId, Region FROM calls) USING (ResourceId) GROUP BY ROLLUP (Region, StoreNumber)""")

# Measures -----------------------------------------------------------------

oracle("device_rank", ["fact"], f"""
  SELECT DeviceId, {r('TotalCost')}, rank() OVER (ORDER BY round(TotalCost, 9) DESC) AS CostRank
  FROM (SELECT DeviceId, sum(AllocatedCost) AS TotalCost FROM fact GROUP BY 1)""")
oracle("usage_shares", ["usage", "totals"], f"""
  SELECT {USAGE_ROWS}, {r('CASE WHEN tok > 0 THEN TokensUsed / tok ELSE 0 END', 'TokenShare')},
    {r('CASE WHEN cal > 0 THEN ApiCalls / cal ELSE 0 END', 'ApiCallShare')}
  FROM usage JOIN totals USING (TimeWindow, ResourceId)""")
oracle("model_cost_share", ["fact"], f"""
  SELECT ModelFamily, {r('sum(AllocatedCost)', 'TotalCost')},
    {r('sum(AllocatedCost) / (SELECT sum(AllocatedCost) FROM fact)', 'CostShare')} FROM fact GROUP BY 1""")
cte("monthly", ["shipped"], """
  SELECT CAST(date_trunc('month', UsageDate) AS DATE) AS m, sum(PreTaxCost) AS c FROM shipped GROUP BY 1""")
cte("all_months", ["monthly"], """
  SELECT CAST(x.m AS DATE) AS m, coalesce(c, 0) AS c
  FROM (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS m FROM monthly) x
  LEFT JOIN monthly ON monthly.m = CAST(x.m AS DATE)""")
cte("monthly_pairs", ["all_months"], """
  SELECT a.m, a.c, coalesce(b.c, 0) AS p,
    (SELECT sum(x.c) FROM all_months x WHERE x.m <= a.m AND x.m >= a.m - INTERVAL 2 MONTH) AS three
  FROM all_months a LEFT JOIN all_months b ON b.m = a.m - INTERVAL 1 MONTH""")
oracle("monthly_cost", ["monthly"], f'SELECT CAST(m AS VARCHAR) AS "Month", {r("c", "Cost")} FROM monthly')
oracle("cost_vs_prev_month", ["monthly_pairs"], f"""
  SELECT CAST(m AS VARCHAR) AS "Month", {r('c', 'CurrentCost')}, {r('p', 'PreviousCost')}, {r('c - p', 'CostChange')}
  FROM monthly_pairs""")
oracle("cost_forecast", ["monthly_pairs"], f"""
  SELECT CAST(m AS VARCHAR) AS "Month", {r('c', 'CurrentCost')}, {r('p', 'PreviousCost')}, {r('three', 'LastThreeMonths')},
    {r('CASE WHEN p <> 0 THEN (c - p) / p END', 'GrowthRate')},
    {r('CASE WHEN p <> 0 THEN c * (1 + (c - p) / p) ELSE c END', 'ForecastCost')} FROM monthly_pairs""")
oracle("trailing_30d_cost", ["shipped"], f"""
  SELECT CAST(d AS VARCHAR) AS "Date", {r('c', 'Cost')},
    {r('sum(c) OVER (ORDER BY d RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)', 'TrailingCost')}
  FROM (SELECT CAST(UsageDate AS DATE) AS d, sum(PreTaxCost) AS c FROM shipped GROUP BY 1)""")
cte("kept_fact", ["fact"], "SELECT TimeWindow, ResourceId, MeterName, DeviceId, StoreNumber, AllocatedCost FROM fact")
oracle("cost_anomaly_2sigma", ["kept_fact"], f"""
  SELECT {KEY}, {r('AllocatedCost')}, CASE WHEN AllocatedCost > mu + 2 * sd THEN 'High'
    WHEN AllocatedCost < mu - 2 * sd THEN 'Low' ELSE 'Normal' END AS CostAnomaly
  FROM (SELECT *, avg(AllocatedCost) OVER () AS mu, stddev_samp(AllocatedCost) OVER () AS sd FROM kept_fact)""")
oracle("peak_hours", ["calls"], f"""
  SELECT deviceId, storeNumber, {big('h', '"Hour"')}, {big('t', 'TotalTokens')}, {r('q', 'Threshold')}
  FROM (SELECT *, quantile_cont(t, 0.8) OVER (PARTITION BY deviceId, storeNumber) AS q
        FROM (SELECT deviceId, storeNumber, hour(TimeGenerated) AS h, CAST(sum(TokensUsed) AS DOUBLE) AS t FROM calls GROUP BY ALL))
  WHERE t >= q""")
for _name, _column in (("top_devices", "DeviceId"), ("top_stores", "StoreNumber")):
    oracle(_name, ["fact"], f"""
  SELECT {_column}, {r('c', 'TotalCost')} FROM (SELECT {_column}, sum(AllocatedCost) AS c FROM fact GROUP BY 1)
  ORDER BY c DESC, {_column} LIMIT 10""")
oracle("recent_calls", ["calls"], f"""
  SELECT TimeGenerated, {ROLE} AS AppRoleName, 'FinOpsApiCall ' || RequestId || ' status ' ||
    CASE WHEN k % 10 = 0 THEN '429' WHEN k % 10 = 1 THEN 'Rate Limit' ELSE 'ok' END AS Message
  FROM calls ORDER BY TimeGenerated DESC, event_id DESC LIMIT 10""")
oracle("top_device_cost", ["fact"], f"""
  SELECT DeviceId, {r('c', 'TopDeviceCost')} FROM (SELECT DeviceId, sum(AllocatedCost) AS c FROM fact GROUP BY 1)
  ORDER BY c DESC, DeviceId DESC LIMIT 1""")

# Reports ------------------------------------------------------------------

oracle("kpi_core", ["fact"], f"""
  SELECT {r('sum(AllocatedCost)', 'TotalCost')}, {big('sum(TokensUsed)', 'TotalTokens')},
    count(DISTINCT DeviceId) AS ActiveDevices, count(DISTINCT StoreNumber) AS StoreCount,
    {r('sum(AllocatedCost) / sum(TokensUsed)', 'CostPerToken')} FROM fact""")
oracle("store_cost_known", ["fact"], f"""
  SELECT StoreNumber, {r('sum(AllocatedCost)', 'StoreCost')}, count(*) AS StoreApiCount
  FROM fact WHERE StoreNumber <> 'unknown' GROUP BY 1""")
oracle("gpt5_measures", ["fact"], f"""
  SELECT {r('g5', 'Gpt5Cost')}, {r('g5 / g4', 'Gpt5ToGpt4CostRatio')}, {r('t5 / g5', 'Gpt5TokensPerCost')}
  FROM (SELECT sum(AllocatedCost) FILTER (WHERE ModelFamily LIKE 'GPT-5%') AS g5,
    sum(AllocatedCost) FILTER (WHERE ModelFamily LIKE 'GPT-4%') AS g4,
    CAST(sum(TokensUsed) FILTER (WHERE ModelFamily LIKE 'GPT-5%') AS DOUBLE) AS t5 FROM fact)""")
oracle("model_performance_score", ["fact"], f"""
  SELECT ModelFamily, {r('sum(TokensUsed) / sum(AllocatedCost) / (avg(AvgResponseTime) / 1000)', 'PerformanceScore')}
  FROM fact GROUP BY 1""")
oracle("model_efficiency", ["fact"], f"""
  SELECT ModelFamily, {big('sum(TokensUsed)', 'TotalTokens')}, {r('sum(AllocatedCost)', 'TotalCost')},
    {r('avg(AvgResponseTime)', 'AvgResponseTime')}, {r('sum(AllocatedCost) / sum(TokensUsed)', 'CostPerToken')}
  FROM fact GROUP BY 1""")
oracle("shift_pivot", ["fact"], f"""
  SELECT StoreNumber, """ + ", ".join(
    r(f"sum(CASE WHEN ShiftCategory = '{s}' THEN AllocatedCost ELSE 0 END)", f"{s}Cost")
    for s in ("Morning", "Evening", "Night")) + " FROM fact GROUP BY 1")
oracle("dim_date", ["calls"], f"""
  SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS "Date", {big('year(d)', '"Year"')}, {big('month(d)', '"Month"')},
    monthname(d) AS MonthName, 'Q' || quarter(d) AS "Quarter", {big('dayofweek(d) + 1', 'Weekday')},
    dayname(d) AS WeekdayName, isodow(d) <= 5 AS IsBusinessDay, {big('day(d)', 'DayOfMonth')}
  FROM (SELECT unnest(generate_series(date_trunc('day', min(TimeGenerated)), max(TimeGenerated), INTERVAL 1 DAY)) AS d
        FROM calls)""")
oracle("usage_heatmap", ["calls"], "SELECT deviceId AS DeviceId, " + ", ".join(
    f"count(*) FILTER (WHERE hour(TimeGenerated) = {h}) AS Hour{h:02d}" for h in range(24)) + " FROM calls GROUP BY 1")
oracle("model_by_store", ["fact"], f"""
  SELECT StoreNumber, ModelFamily, {r('c', 'Cost')}, {big('t', 'Tokens')},
    first_value(ModelFamily) OVER (PARTITION BY StoreNumber ORDER BY c DESC, ModelFamily DESC) AS PreferredModel
  FROM (SELECT StoreNumber, ModelFamily, sum(AllocatedCost) AS c, sum(TokensUsed) AS t FROM fact GROUP BY 1, 2)""")
oracle("daily_cost_trend", ["fact"], f"""
  SELECT CAST(CAST(TimeWindow AS DATE) AS VARCHAR) AS "Date", StoreNumber, {r('sum(AllocatedCost)', 'Cost')}
  FROM fact GROUP BY 1, 2
  UNION ALL
  SELECT CAST(CAST(TimeWindow AS DATE) AS VARCHAR), 'all', round(sum(AllocatedCost) + 3e-10, 6) FROM fact GROUP BY 1""")
cte("day_usage", ["calls"], """
  SELECT CAST(TimeGenerated AS DATE) AS d, ResourceId, deviceId AS DeviceId, storeNumber AS StoreNumber,
    CAST(sum(TokensUsed) AS BIGINT) AS tok FROM calls GROUP BY ALL""")
cte("day_totals", ["day_usage"], """
  SELECT d, ResourceId, CAST(sum(tok) AS BIGINT) AS total, count(*) AS n FROM day_usage GROUP BY ALL""")
cte("day_cost", ["cost"], """
  SELECT CAST(UsageDate AS DATE) AS d, ResourceId, sum(Cost) AS cost FROM cost GROUP BY ALL""")
oracle("daily_usage_share", ["day_usage", "day_totals", "day_cost"], f"""
  SELECT CAST(d AS VARCHAR) AS "Date", ResourceId, DeviceId, StoreNumber,
    {r(f'(CASE WHEN total > 0 THEN tok / total ELSE {ONE} / n END) * cost', 'AllocatedCost')},
    {r('CASE WHEN total > 0 THEN tok / total ELSE 0 END', 'UsageShare')}, {r('cost', 'DailyCost')}
  FROM day_usage JOIN day_totals USING (d, ResourceId) JOIN day_cost USING (d, ResourceId)""")

# Analyses -----------------------------------------------------------------


def pattern_ctes(where: str) -> str:
    return f"""
  pt AS (SELECT * FROM calls WHERE {where} AND deviceId <> 'unknown' AND storeNumber <> 'unknown'),
  ph AS (SELECT deviceId, storeNumber, CAST(sum(TokensUsed) AS DOUBLE) / count(DISTINCT TimeWindow) AS tph,
      CAST(count(*) AS DOUBLE) / count(DISTINCT TimeWindow) AS cph,
      least(CAST(sum(TokensUsed) AS DOUBLE) / count(*) / 1000, 1.0) AS eff FROM pt GROUP BY ALL),
  hod AS (SELECT deviceId, storeNumber, hour(TimeGenerated) AS h, CAST(sum(TokensUsed) AS DOUBLE) AS t FROM pt GROUP BY ALL),
  hq AS (SELECT deviceId, storeNumber, quantile_cont(t, 0.8) AS q,
      greatest(0.0, 1 - coalesce(stddev_samp(t) / (avg(t) + 1), 0)) AS consistency FROM hod GROUP BY ALL),
  pk AS (SELECT deviceId, storeNumber, array_to_string(list(h ORDER BY h), ',') AS peaks
      FROM hod JOIN hq USING (deviceId, storeNumber) WHERE t >= q GROUP BY ALL),
  patterns AS (SELECT * FROM ph JOIN hq USING (deviceId, storeNumber) JOIN pk USING (deviceId, storeNumber)),
  recent AS (SELECT deviceId, storeNumber, CAST(sum(TokensUsed) AS DOUBLE) / count(DISTINCT TimeWindow) AS now_t,
      CAST(count(*) AS DOUBLE) / count(DISTINCT TimeWindow) AS now_c
      FROM calls WHERE {before('TimeGenerated', INSIDE, '1 DAY')} GROUP BY ALL),
  compared AS (SELECT *, abs(now_t - tph) / greatest(tph, 1) AS dt, abs(now_c - cph) / greatest(cph, 1) AS dc
      FROM recent JOIN patterns USING (deviceId, storeNumber))"""


def with_patterns(where: str, select: str) -> str:
    return sql(["calls"], "").rstrip() + ",\n" + pattern_ctes(where) + select


WEEK_BEFORE = before("TimeGenerated", DAY_BEFORE, "7 DAY")
PATTERN = f"""{r('tph', 'avg_tokens_per_hour')}, {r('cph', 'avg_api_calls_per_hour')}, peaks AS peak_hours,
    {r('consistency', 'usage_consistency_score')}, {r('eff', 'cost_efficiency_score')}"""
ORACLES["device_usage_patterns"] = with_patterns(before("TimeGenerated", INSIDE, "7 DAY"), f"""
  SELECT deviceId AS device_id, storeNumber AS store_number, {PATTERN} FROM patterns""")
ORACLES["pattern_lookup_join"] = with_patterns(WEEK_BEFORE, f"""
  SELECT deviceId AS device_id, storeNumber AS store_number, {r('now_t', 'current_tokens_per_hour')},
    {r('now_c', 'current_calls_per_hour')}, {PATTERN} FROM compared""")
ORACLES["usage_anomalies"] = with_patterns(WEEK_BEFORE, f"""
  SELECT deviceId AS device_id, storeNumber AS store_number, {r('now_t', 'current_tokens_per_hour')},
    {r('tph', 'expected_tokens_per_hour')}, {r('dt', 'token_deviation')}, {r('dc', 'call_deviation')},
    CASE WHEN now_t > tph THEN 'usage_spike' ELSE 'usage_drop' END AS anomaly_type,
    CASE WHEN greatest(dt, dc) > 0.75 THEN 'high' ELSE 'medium' END AS severity
  FROM compared WHERE dt > 0.5 OR dc > 0.5""")

cte("models", ["fact"], """
  SELECT DeviceId, StoreNumber, count(*) AS n,
    CASE WHEN min(TokensUsed) < max(TokensUsed) THEN corr(TokensUsed, AllocatedCost) END AS tc,
    CASE WHEN min(ApiCalls) < max(ApiCalls) THEN corr(ApiCalls, AllocatedCost) END AS cc,
    sum(AllocatedCost) / greatest(sum(TokensUsed), 1) AS cpt, sum(AllocatedCost) / greatest(sum(ApiCalls), 1) AS cpc,
    avg(AllocatedCost) AS hist
  FROM fact GROUP BY DeviceId, StoreNumber HAVING count(*) >= 5 AND min(AllocatedCost) < max(AllocatedCost)""")
cte("current_usage", ["calls"], f"""
  SELECT deviceId AS DeviceId, storeNumber AS StoreNumber, sum(TokensUsed) AS tokens, count(*) AS n_calls
  FROM calls WHERE {before('TimeGenerated', INSIDE, '1 DAY')} GROUP BY ALL""")
MODEL = f"""{big('n', 'data_points')}, {r('tc', 'token_coefficient')}, {r('cc', 'call_coefficient')},
    {r('cpt', 'avg_cost_per_token')}, {r('cpc', 'avg_cost_per_call')}, {r('hist', 'historical_avg')}"""
oracle("device_cost_models", ["models"], f"SELECT DeviceId, StoreNumber, {MODEL} FROM models")
oracle("model_lookup_join", ["models", "current_usage"], f"""
  SELECT DeviceId, StoreNumber, {big('tokens', 'current_tokens')}, {big('n_calls', 'current_calls')}, {MODEL}
  FROM current_usage JOIN models USING (DeviceId, StoreNumber)""")
oracle("predict_cost", ["models", "current_usage"], f"""
  SELECT DeviceId, StoreNumber, {r('greatest(CASE WHEN tc > 0.5 THEN tokens * cpt WHEN cc > 0.5 THEN n_calls * cpc ELSE hist END, 0)', 'PredictedCost')}
  FROM current_usage JOIN models USING (DeviceId, StoreNumber)""")
cte("series", ["fact"], "SELECT StoreNumber, DeviceId, TimeWindow, sum(AllocatedCost) AS c FROM fact GROUP BY ALL")
cte("against", ["series"], """
  SELECT * FROM (
    SELECT StoreNumber, DeviceId, count(*) AS n, CASE WHEN min(c) < max(c) AND min(o) < max(o) THEN corr(c, o) END AS x
    FROM (SELECT StoreNumber, DeviceId, round(a.c, 9) AS c, round(t.c - a.c, 9) AS o FROM series a
          JOIN (SELECT StoreNumber, TimeWindow, sum(c) AS c, count(*) AS n FROM series GROUP BY ALL) t
            USING (StoreNumber, TimeWindow) WHERE t.n > 1)
    GROUP BY ALL) WHERE n >= 2 AND abs(x) > 0.1""")
oracle("device_pair_join", ["against"], f"""
  SELECT StoreNumber, DeviceId, n AS CommonWindows, {r('x', 'Correlation')} FROM against""")
oracle("device_spillover", ["against", "series"], f"""
  SELECT StoreNumber, DeviceId, n AS CommonWindows, {r('x', 'Correlation')},
    CASE WHEN x > 0 THEN 'positive' ELSE 'negative' END AS Relationship, device_count,
    {r('total_store_cost')}, {r('total_store_cost / device_count', 'avg_device_cost')}
  FROM against JOIN (SELECT StoreNumber, count(DISTINCT DeviceId) AS device_count, sum(c) AS total_store_cost
                   FROM series GROUP BY 1) USING (StoreNumber)""")
# All pairs of a store, over buckets of three days, with 0 where a device had no cost.
cte("pieces", ["fact"], """
  SELECT StoreNumber, DeviceId, CAST(floor(epoch_us(TimeWindow - TIMESTAMP '2024-01-01' + TIMESTAMP '1970-01-01') / 259200e6) AS BIGINT) AS t, sum(AllocatedCost) AS c
  FROM fact WHERE TimeWindow < TIMESTAMP '2024-01-31' GROUP BY ALL""")
cte("grid", ["pieces"], """
  SELECT d.StoreNumber, d.DeviceId, g.t, round(coalesce(p.c, 0), 9) AS x
  FROM (SELECT DISTINCT StoreNumber, DeviceId FROM pieces) d CROSS JOIN range(0, 10) g(t)
  LEFT JOIN pieces p ON p.StoreNumber = d.StoreNumber AND p.DeviceId = d.DeviceId AND p.t = g.t""")
cte("pair_corr", ["grid"], """
  SELECT a.StoreNumber, a.DeviceId, b.DeviceId AS other, round(corr(a.x, b.x), 9) AS c
  FROM grid a JOIN grid b ON a.StoreNumber = b.StoreNumber AND a.t = b.t AND a.DeviceId <> b.DeviceId
  GROUP BY ALL HAVING min(a.x) < max(a.x) AND min(b.x) < max(b.x)""")
oracle("device_correlation_index", ["pair_corr", "pieces"], f"""
  SELECT StoreNumber, DeviceId, arg_min(other, (-abs(c), other)) AS Partner, {r('arg_min(c, (-abs(c), other))', 'Correlation')},
    CASE WHEN arg_min(c, (-abs(c), other)) > 0 THEN 'positive' ELSE 'negative' END AS Relationship, count(*) AS Links,
    least(DeviceId, min(other)) AS "Group", device_count, {r('total_store_cost')}, {r('total_store_cost / device_count', 'avg_device_cost')}
  FROM pair_corr JOIN (SELECT StoreNumber, count(DISTINCT DeviceId) AS device_count, sum(c) AS total_store_cost FROM pieces GROUP BY 1) USING (StoreNumber)
  WHERE abs(c) > 0.5 GROUP BY StoreNumber, DeviceId, device_count, total_store_cost""")

cte("figures", ["calls"], """
  SELECT count(*) AS n, count(DISTINCT deviceId) AS u, avg(CASE WHEN deviceId = 'unknown' THEN 1.0 ELSE 0.0 END) AS unk,
      avg(TokensUsed) AS m, var_samp(TokensUsed) / greatest(avg(TokensUsed), 1) AS ts,
      (SELECT var_samp(x) / greatest(avg(x), 1) FROM
        (SELECT count(*) AS x FROM calls GROUP BY deviceId, storeNumber)) AS cs FROM calls""")


def recommendation(billed: str) -> str:
    return f"""
  SELECT n AS records, u AS unique_devices, {r('unk', 'unknown_device_ratio')}, {r('m', 'token_mean')},
    {r('ts', 'token_spread')}, {r('cs', 'call_spread')}, {big(billed, 'billed_lines')},
    CASE WHEN {billed} = 0 THEN 'equal' WHEN unk > 0.5 THEN 'equal' WHEN ts > 2 AND m > 0 THEN 'token-based' WHEN cs > 1.5 THEN 'usage-based'
         ELSE 'proportional' END AS recommended_method,
    CASE WHEN {billed} = 0 THEN 'no cost to split' WHEN unk > 0.5 THEN 'most calls name no device' WHEN ts > 2 AND m > 0 THEN 'tokens vary much between calls'
         WHEN cs > 1.5 THEN 'calls vary much between devices' WHEN u > 10 THEN 'many devices of moderate variance'
         ELSE 'usage is balanced' END AS reason
  FROM figures"""


oracle("recommend_allocation", ["figures", "cost"], recommendation("(SELECT count(*) FROM cost)"))
oracle("recommend_allocation_no_cost", ["figures", "cost"], recommendation("(SELECT count(*) FROM cost WHERE Cost < 0)"))

# States per day -----------------------------------------------------------

IN_RANGE = "TimeWindow >= TIMESTAMP '2024-01-08' AND TimeWindow < TIMESTAMP '2024-01-15'"
TIME_IN_RANGE = IN_RANGE.replace("TimeWindow", "TimeGenerated")
cte("range_fact", ["fact"], f"SELECT * FROM fact WHERE {IN_RANGE}")


oracle("range_summary", ["range_fact"], f"""
  SELECT count(*) AS total_records, {r('sum(AllocatedCost)', 'total_allocated_cost')},
    count(DISTINCT DeviceId) AS unique_devices, count(DISTINCT StoreNumber) AS unique_stores,
    count(DISTINCT DeviceStoreKey) AS unique_device_store_combinations,
    {r('100.0 * count(*) FILTER (WHERE IsUnknownDevice) / count(*)', 'unknown_device_percentage')},
    {r('100.0 * count(*) FILTER (WHERE IsUnknownStore) / count(*)', 'unknown_store_percentage')},
    {r('avg(CorrelationConfidence)', 'avg_confidence')}, {r('avg(AllocationAccuracy)', 'avg_accuracy')},
    {r('avg(DeviceUtilizationScore)', 'avg_utilization_score')}
  FROM range_fact""")
oracle("range_store_performance", ["range_fact"], f"""
  SELECT StoreNumber, {PERFORMANCE}, count(DISTINCT DeviceId) AS DeviceId_nunique FROM range_fact GROUP BY StoreNumber""")
oracle("range_model_usage", ["range_fact"], f"""
  SELECT ModelFamily, TimeWindow AS HourStart, {r('sum(AllocatedCost)', 'TotalCost')},
    {big('sum(TokensUsed)', 'TotalTokens')}, count(DISTINCT DeviceId) AS UniqueDevices
  FROM range_fact WHERE ModelFamily LIKE 'GPT-5%' GROUP BY 1, 2""")
cte("range_models", ["range_fact"], CTES["models"].replace("FROM fact", "FROM range_fact"))
oracle("range_cost_models", ["range_models"], f"SELECT DeviceId, StoreNumber, {MODEL} FROM range_models")
ORACLES["range_usage_patterns"] = with_patterns(TIME_IN_RANGE, f"""
  SELECT deviceId AS device_id, storeNumber AS store_number, {PATTERN} FROM patterns""")
oracle("range_busy_hours", ["calls"], f"""
  SELECT deviceId AS device_id, storeNumber AS store_number, count(*) AS active_hours, {r('quantile_disc(t, 0.8)', 'busy_hour_tokens')}
  FROM (SELECT deviceId, storeNumber, TimeWindow, CAST(sum(TokensUsed) AS DOUBLE) AS t FROM calls WHERE {TIME_IN_RANGE} GROUP BY ALL)
  GROUP BY ALL""")

# Sinks --------------------------------------------------------------------

oracle("write_fact", ["fact"], "\nUNION ALL\n".join(
    f"SELECT '{f}' AS Format, ModelFamily, count(*) AS n, {r('sum(AllocatedCost)', 'AllocatedCost')}, max(TimeWindow) AS \"last\" "
    "FROM fact GROUP BY ModelFamily" for f in ("parquet", "json", "csv")))
oracle("write_raw", ["calls", "billing"], f"""
  SELECT 'telemetry' AS kind, count(*) AS n, {r('sum(TokensUsed)', 'amount')} FROM calls
  UNION ALL SELECT 'cost', count(*), round(sum(PreTaxCost) + 3e-10, 6) FROM billing""")
oracle("storage_metrics", ["fact"], """
  SELECT TableName, true AS HasFiles, CAST(3 AS BIGINT) AS Days, runs AS Runs, CAST(runs * n AS BIGINT) AS "Rows", CAST(2 AS BIGINT) AS ExpiredDays
  FROM (VALUES ('parquet', CAST(4 AS BIGINT)), ('json', 4), ('csv', 4), ('total', 12)) t(TableName, runs),
    (SELECT count(*) AS n FROM fact)""")
oracle("retention_report", ["fact"], """
  SELECT TableName, "Date", CAST(1 AS BIGINT) AS RunsToDelete, n AS RowsToFree, true AS FreesBytes
  FROM (VALUES ('parquet'), ('json'), ('csv')) t(TableName), (VALUES ('2024-01-31'), ('2024-02-01')) d("Date"),
    (SELECT count(*) AS n FROM fact)""")
ORACLES["list_partitions"] = "SELECT '2024/01/31' AS \"Partition\", '2024-01-31' AS \"Date\""

# Streams ------------------------------------------------------------------

oracle("stream_ingest", ["valid_events"], f"""
  SELECT eventType, TimeGenerated AS "timestamp", RequestId AS correlationId, deviceId, storeNumber,
    {big('StatusCode', 'statusCode')}, {big('TokensUsed', 'tokensUsed')}, ResourceId AS resourceId FROM valid_events""")
oracle("stream_route_errors", ["valid_events", "calls"], """
  SELECT CASE WHEN event_type = 'error' THEN 'error' ELSE 'call' END AS Route, RequestId AS correlation_id,
    nullif(deviceId, 'unknown') AS device_id, nullif(storeNumber, 'unknown') AS store_number,
    CAST(nullif(TokensUsed, 0) AS VARCHAR) AS tokens_used, CAST(StatusCode AS VARCHAR) AS status_code FROM valid_events
  UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL, NULL FROM calls WHERE event_id % 50 IN (0, 1, 2)""")
oracle("stream_batch_counts", ["calls"], """
  SELECT count(*) AS batch_size, count(*) FILTER (WHERE event_id % 50 NOT IN (0, 1, 2)) AS processed_count,
    count(*) FILTER (WHERE event_id % 50 IN (0, 1, 2)) AS error_count FROM calls""")
for _name in ("stream_usage_window", "stream_dedup_usage_window"):
    oracle(_name, ["usage"], f"SELECT {USAGE_ROWS} FROM usage")
oracle("stream_closed_usage", ["usage", "calls"], f"""
  SELECT {USAGE_ROWS} FROM usage WHERE TimeWindow + INTERVAL 1 HOUR <= (SELECT max(TimeGenerated) FROM calls) - INTERVAL 4 HOUR""")
oracle("stream_usage_of_changes", ["usage"], f"SELECT {USAGE_ROWS} FROM usage")
oracle("stream_late_cost_notes", ["usage", "cost"], """
  SELECT CAST(0 AS BIGINT) AS "Batch", (SELECT count(*) FROM cost) AS LinesChanged, (SELECT count(DISTINCT TimeWindow) FROM cost) AS "Windows",
    (SELECT count(*) FROM usage WHERE TimeWindow IN (SELECT TimeWindow FROM cost)) AS UsageRowsRead
  UNION ALL SELECT 1, 0, 0, 0
  UNION ALL SELECT 2, count(*), count(DISTINCT TimeWindow),
    (SELECT count(*) FROM usage WHERE TimeWindow IN (SELECT TimeWindow FROM cost WHERE cost_seq = 2 AND UsageDate < TIMESTAMP '2024-01-02'))
  FROM cost WHERE cost_seq = 2 AND UsageDate < TIMESTAMP '2024-01-02'""")
for _name in ("stream_dedup", "stream_dedup_changes"):
    ORACLES[_name] = ORACLES["dedup_telemetry"]
cte("run_usage", ["calls"], f"""
  SELECT TimeWindow, ResourceId, deviceId, storeNumber, CAST(sum(TokensUsed) AS BIGINT) AS tok
  FROM calls WHERE {before('TimeGenerated', INSIDE, '72 HOUR')} GROUP BY ALL""")
ORACLES["scheduled_run"] = sql(["run_usage", "cost"], "").rstrip() + f""",
  run_cost AS (SELECT * FROM cost WHERE {before('UsageDate', INSIDE, '72 HOUR')}),
  run_totals AS (SELECT TimeWindow, ResourceId, CAST(sum(tok) AS BIGINT) AS total, count(*) AS n FROM run_usage GROUP BY ALL),
  run_fact AS (SELECT (CASE WHEN total > 0 THEN tok / total ELSE {ONE} / n END) * Cost AS AllocatedCost
    FROM run_usage JOIN run_totals USING (TimeWindow, ResourceId) JOIN run_cost USING (TimeWindow, ResourceId))
  """ + run_stats(f"WHERE {before('TimeGenerated', INSIDE, '72 HOUR')}", "").replace("FROM cost", "FROM run_cost")
