"""Vietnamese table and column names, for dashboards built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Table names.
TABLES = {
    "sales": "sales_report",
    "dim_product": "dim_sanpham",
    "dim_customer": "dim_khachhang",
    "inventory": "inventory",
    "stock_snapshot": "snapshot_tonkho",
    "agg_day": "agg_ngay",
    "agg_week": "agg_tuan",
    "agg_month": "agg_thang",
    "agg_quarter": "agg_quy",
    "agg_year": "agg_nam",
    "report_store_month_pnl": "bc_doanhthu_cuahang",
    "report_region_profit": "bc_loinhuan_vung",
    "report_top_products_revenue": "bc_top_sanpham",
    "report_low_stock": "bc_canhbao_tonkho",
    "report_top_products_profit": "bc_loinhuan_sanpham",
    "report_stock_value": "bc_giatri_ton",
    "report_channel_pnl": "bc_doanhthu_kenh",
    "report_device_payment": "bc_online_thietbi",
    "report_segment_revenue": "bc_doanhthu_segment",
    "report_stock_trend": "bc_xuhuong_tonkho",
    "report_daily_series": "bc_kinhdoanh_ngay",
    "report_revenue_forecast": "bc_dubao",
    "report_store_clusters": "bc_phancum_cuahang",
    "report_promo_profit_corr": "bc_tuongquan",
    "report_replenishment_plan": "bc_kehoach_nhaphang",
    "rt_stats": "rt_thongke",
    "rt_alerts": "rt_canhbao",
}

# Column names.
COLUMNS = {
    "period": "ky",
    "day": "ngay",
    "month": "thang",
    "channel": "kenh",
    "product_name": "ten_sp",
    "stock_value": "gia_tri_ton",
    "snapshot_date": "ngay_chot",
    "low_stock_products": "so_sp_duoi_nguong",
    "units_sold": "so_luong_ban",
    "rows_sold": "so_dong_ban",
    "row_count": "so_dong",
    "order_count": "so_don",
    "txn_count": "so_gd",
    "processed_at": "thoi_diem",
    "monthly_demand": "du_bao_thang",
    "suggested_qty": "de_xuat_nhap",
    "expected_cost": "chi_phi_nhap_du_kien",
    "t": "thang_t",
    "revenue_forecast": "doanh_thu_dubao",
    "metric": "chi_tieu",
    "value": "gia_tri",
}

# Money columns are renamed in reports and aggregates only, rows of single sales keep theirs.
MONEY = {"revenue": "doanh_thu", "cost": "chi_phi", "profit": "loi_nhuan"}
SINGLE_SALES = ("sales", "rt_alerts", "report_store_clusters")

# Where one table differs.
SPECIAL = {
    "report_store_clusters": {"txn_count": "n_txn", "cluster": "prediction"},
    "report_replenishment_plan": {"stock_qty": "ton_hien_tai"},
}
METRICS = {"promotion_vs_profit": "khuyen_mai_vs_loi_nhuan"}


def vietnamese(df: DataFrame, table: str) -> tuple[DataFrame, str]:
    """The table under its Vietnamese name and columns."""
    names = COLUMNS | ({} if table in SINGLE_SALES else MONEY) | SPECIAL.get(table, {})
    if table == "report_promo_profit_corr":
        df = df.replace(METRICS, subset=["metric"])
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns}), TABLES.get(table, table)
