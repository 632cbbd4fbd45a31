"""Rule-based labels as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts of the published tables.
OVERSOLD, OVERBOUGHT, NEUTRAL = "Quá bán", "Quá mua", "Trung tính"
STRONG_UP, MILD_UP, MILD_DOWN, STRONG_DOWN = "Tăng mạnh", "Tăng nhẹ", "Giảm nhẹ", "Giảm mạnh"
RISING, FALLING = "Tăng", "Giảm"
DIVIDEND_NONE, DIVIDEND_HIGH, DIVIDEND_FAIR, DIVIDEND_LOW = "Không có", "Hấp dẫn", "Khá", "Thấp"
ROE_EXCELLENT, ROE_GOOD, ROE_AVERAGE, ROE_WEAK = "Xuất sắc", "Tốt", "Trung bình", "Yếu"
CHEAP, FAIR, EXPENSIVE, NOT_AVAILABLE = "Rẻ", "Hợp lý", "Đắt", "N/A"
NEAR_HIGH, NEAR_LOW, MID_RANGE = "Gần đỉnh", "Gần đáy", "Trung bình"
STRONG_BUY, BUY, HOLD, SELL, STRONG_SELL = "Mua mạnh", "Mua", "Nắm giữ", "Bán", "Bán mạnh"
# Stock class by (quality of return on equity, valuation).
STOCK_CLASSES = {
    ("good", CHEAP): "Hàng hiệu giá hời",
    ("good", FAIR): "Tăng trưởng bền vững",
    ("good", EXPENSIVE): "Tăng trưởng nóng",
    ("average", CHEAP): "Đầu tư an toàn",
    ("average", FAIR): "Theo dõi thêm",
    ("average", EXPENSIVE): "Bị định giá cao",
    ("weak", CHEAP): "Bẫy định giá",
    ("weak", FAIR): "Cổ phiếu yếu",
    ("weak", EXPENSIVE): "Rủi ro cao",
}


def rsi_label(rsi: Column) -> Column:
    label = F.when(rsi <= 30, OVERSOLD).when(rsi >= 70, OVERBOUGHT).otherwise(NEUTRAL)
    return F.when(rsi.isNotNull(), label)


def trend_label(close: Column, fast: Column, slow: Column) -> Column:
    """Close against the short mean, and the short mean against the long one."""
    above, rising = close > fast, fast > slow
    label = F.when(above, F.when(rising, STRONG_UP).otherwise(MILD_UP)).otherwise(
        F.when(~above & rising, MILD_DOWN).otherwise(STRONG_DOWN)
    )
    return F.when(fast.isNotNull() & slow.isNotNull(), label)


def macd_label(macd: Column, previous: Column) -> Column:
    label = (
        F.when((macd > 0) & (macd > previous), RISING)
        .when((macd < 0) & (macd < previous), FALLING)
        .otherwise(NEUTRAL)
    )
    return F.when(macd.isNotNull(), label)


def dividend_label(rate: Column) -> Column:
    return (
        F.when(rate > 8, DIVIDEND_HIGH)
        .when(rate >= 4, DIVIDEND_FAIR)
        .when(rate > 0, DIVIDEND_LOW)
        .otherwise(DIVIDEND_NONE)
    )


def roe_label(roe: Column) -> Column:
    label = (
        F.when(roe >= 20, ROE_EXCELLENT).when(roe >= 15, ROE_GOOD).when(roe >= 10, ROE_AVERAGE)
        .otherwise(ROE_WEAK)
    )
    return F.when(roe.isNotNull(), label)


def pe_label(pe: Column, sector_median: Column) -> Column:
    ratio = F.try_divide(pe, sector_median)
    label = F.when(ratio < 0.85, CHEAP).when(ratio <= 1.15, FAIR).otherwise(EXPENSIVE)
    return F.when((pe > 0) & (sector_median > 0), label).otherwise(NOT_AVAILABLE)


def pb_label(pb: Column) -> Column:
    label = F.when(pb < 1.0, CHEAP).when(pb <= 3.0, FAIR).otherwise(EXPENSIVE)
    return F.when(pb > 0, label).otherwise(NOT_AVAILABLE)


def price_position_label(close: Column, high: Column, low: Column) -> Column:
    """Where the close lies inside the 52-week range."""
    place = F.try_divide(close - low, high - low)
    label = F.when(place >= 0.8, NEAR_HIGH).when(place <= 0.2, NEAR_LOW).otherwise(MID_RANGE)
    return F.when(high - low > 0, label)


def stock_class_label(roe_text: Column, pe_text: Column) -> Column:
    quality = (
        F.when(roe_text.isin(ROE_EXCELLENT, ROE_GOOD), "good")
        .when(roe_text == ROE_AVERAGE, "average")
        .when(roe_text.isNotNull(), "weak")
    )
    table = F.create_map(*[F.lit(x) for (q, v), text in STOCK_CLASSES.items() for x in (f"{q}/{v}", text)])
    return F.try_element_at(table, F.concat_ws("/", F.coalesce(quality, F.lit("none")), pe_text))


def trading_action_label(rsi: Column, macd_text: Column, close: Column, sma: Column) -> Column:
    """Two or three agreeing signals buy or sell; an unknown signal leaves the count unknown."""
    def votes(*signals: Column) -> Column:
        return sum((s.cast("int") for s in signals[1:]), signals[0].cast("int"))

    buys = votes(rsi <= 40, macd_text == RISING, close > sma)
    sells = votes(rsi >= 65, macd_text == FALLING, close < sma)
    label = (
        F.when(buys == 3, STRONG_BUY).when(buys == 2, BUY)
        .when(sells == 3, STRONG_SELL).when(sells == 2, SELL).otherwise(HOLD)
    )
    return F.when(rsi.isNotNull() & sma.isNotNull(), label)
