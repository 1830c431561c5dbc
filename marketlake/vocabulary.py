"""Fixed values shared by the jobs: indicator names, series tags, path layouts."""

from __future__ import annotations

# English indicator name | Vietnamese name | code. Used when statement
# files are loaded.
LOADER_INDICATORS = """
Revenue (Bn. VND) | Doanh thu | REV
Attribute to parent company (Bn. VND) | LNST của cổ đông công ty mẹ | NET_PROFIT_PARENT
Financial Income | Doanh thu tài chính | FIN_INC
Sales | Doanh thu bán hàng | SALES
Sales deductions | Các khoản giảm trừ doanh thu | SALES_DED
Net Sales | Doanh thu thuần | NET_SALES
Cost of Sales | Giá vốn hàng bán | COGS
Gross Profit | Lợi nhuận gộp | GROSS_PROFIT
Financial Expenses | Chi phí tài chính | FIN_EXP
Selling Expenses | Chi phí bán hàng | SELL_EXP
General & Admin Expenses | Chi phí quản lý doanh nghiệp | ADMIN_EXP
Operating Profit/Loss | Lợi nhuận từ HĐKD | OPER_PROFIT
Other income | Thu nhập khác | OTH_INC
Other Income/Expenses | Thu nhập/Chi phí khác | OTH_INC_EXP
Net other income/expenses | Lợi nhuận khác | NET_OTH_PROFIT
Profit before tax | Lợi nhuận trước thuế | PBT
Net Profit For the Year | Lợi nhuận sau thuế thu nhập DN | PAT
Attributable to parent company | LNST phân bổ cho CĐ công ty mẹ | PAT_PARENT
CURRENT ASSETS (Bn. VND) | Tài sản ngắn hạn | CUR_ASSET
Cash and cash equivalents (Bn. VND) | Tiền và tương đương tiền | CASH
Accounts receivable (Bn. VND) | Các khoản phải thu | RECEIVABLES
Net Inventories | Hàng tồn kho ròng | INV_NET
Other current assets | Tài sản ngắn hạn khác | OTH_CUR_ASSET
LONG-TERM ASSETS (Bn. VND) | Tài sản dài hạn | LT_ASSET
Fixed assets (Bn. VND) | Tài sản cố định | FIXED_ASSET
Long-term investments (Bn. VND) | Đầu tư tài chính dài hạn | LT_INVEST
Other non-current assets | Tài sản dài hạn khác | OTH_LT_ASSET
TOTAL ASSETS (Bn. VND) | Tổng cộng tài sản | TOTAL_ASSET
LIABILITIES (Bn. VND) | Nợ phải trả | LIABILITIES
Current liabilities (Bn. VND) | Nợ ngắn hạn | CUR_LIAB
Long-term liabilities (Bn. VND) | Nợ dài hạn | LT_LIAB
OWNER'S EQUITY(Bn.VND) | Vốn chủ sở hữu | EQUITY
Capital and reserves (Bn. VND) | Vốn và các quỹ | CAPITAL_RESERVE
Undistributed earnings (Bn. VND) | LNST chưa phân phối | RETAIN_EARN
TOTAL RESOURCES (Bn. VND) | Tổng cộng nguồn vốn | TOTAL_RESOURCES
Prepayments to suppliers (Bn. VND) | Trả trước cho người bán | PREPAY_SUPP
Inventories, Net (Bn. VND) | Hàng tồn kho | INV
Other current assets (Bn. VND) | Tài sản ngắn hạn khác (Bn) | OTH_CUR_ASSET_BN
Investment and development funds (Bn. VND) | Quỹ đầu tư phát triển | DEV_FUND
Common shares (Bn. VND) | Cổ phiếu phổ thông | COMMON_SHARE
Paid-in capital (Bn. VND) | Vốn góp của chủ sở hữu | PAID_IN_CAP
Advances from customers (Bn. VND) | Người mua trả tiền trước | ADV_CUST
Short-term borrowings (Bn. VND) | Vay và nợ ngắn hạn | ST_DEBT
Long-term prepayments (Bn. VND) | Chi phí trả trước dài hạn | LT_PREPAY
Revenue YoY (%) | Tăng trưởng doanh thu YoY | REV_YOY
Attribute to parent company YoY (%) | Tăng trưởng LNST mẹ YoY | NET_PROFIT_PARENT_YOY
Interest Expenses | Chi phí lãi vay | INT_EXP
Gain/(loss) from joint ventures | Lãi/lỗ từ công ty liên doanh liên kết | JOINT_VENTURE_GAIN
Business income tax - current | Thuế TNDN hiện hành | TAX_CURRENT
Business income tax - deferred | Thuế TNDN hoãn lại | TAX_DEFERRED
Minority Interest | Lợi ích cổ đông thiểu số | MINORITY_INT
Short-term investments (Bn. VND) | Đầu tư tài chính ngắn hạn | ST_INVEST
Long-term loans receivables (Bn. VND) | Phải thu về cho vay dài hạn | LT_LOAN_RECEIV
MINORITY INTERESTS | Lợi ích cổ đông thiểu số (Nguồn vốn) | MINORITY_INTERESTS
Short-term loans receivables (Bn. VND) | Phải thu về cho vay ngắn hạn | ST_LOAN_RECEIV
Long-term borrowings (Bn. VND) | Vay và nợ dài hạn | LT_DEBT
Good will (Bn. VND) | Lợi thế thương mại | GOODWILL
Other long-term assets (Bn. VND) | Tài sản dài hạn khác (Bn) | OTH_LT_ASSET_BN
Other long-term receivables (Bn. VND) | Phải thu dài hạn khác | OTH_LT_RECEIV
Long-term trade receivables (Bn. VND) | Phải thu dài hạn của khách hàng | LT_TRADE_RECEIV
Net Profit/Loss before tax | Lợi nhuận/Lỗ thuần trước thuế | NET_PBT
Depreciation and Amortisation | Khấu hao và hao mòn | DEPRECIATION
Provision for credit losses | Dự phòng tổn thất tín dụng | PROVISION_CREDIT
Unrealized foreign exchange gain/loss | Lãi/lỗ chênh lệch tỷ giá chưa thực hiện | UNREALIZED_FX
Profit/Loss from investing activities | Lãi/lỗ từ hoạt động đầu tư | INVEST_GAIN
Interest Expense | Chi phí lãi vay (Lưu chuyển tiền tệ) | INT_EXP_CF
Operating profit before changes in working capital | Lợi nhuận từ HĐKD trước thay đổi vốn lưu động | OPER_PROFIT_BEFORE_WC
Increase/Decrease in receivables | Tăng/Giảm các khoản phải thu | CF_RECEIVABLES
Increase/Decrease in inventories | Tăng/Giảm hàng tồn kho | CF_INV
Increase/Decrease in payables | Tăng/Giảm các khoản phải trả | CF_PAYABLES
Increase/Decrease in prepaid expenses | Tăng/Giảm chi phí trả trước | CF_PREPAY
Interest paid | Tiền lãi vay đã trả | CF_INT_PAID
Business Income Tax paid | Thuế TNDN đã nộp | CF_TAX_PAID
Net cash inflows/outflows from operating activities | Lưu chuyển tiền thuần từ HĐKD | CFO
Purchase of fixed assets | Tiền chi mua sắm TSCĐ | CF_BUY_FIXED_ASSET
Proceeds from disposal of fixed assets | Tiền thu thanh lý TSCĐ | CF_SELL_FIXED_ASSET
Loans granted, purchases of debt instruments (Bn. VND) | Tiền cho vay, mua công cụ nợ | CF_LOAN_GRANTED
Collection of loans, proceeds from sales of debts instruments (Bn. VND) | Tiền thu hồi cho vay, bán công cụ nợ | CF_LOAN_COLLECT
Investment in other entities | Tiền chi đầu tư góp vốn vào đơn vị khác | CF_INVEST_OTH
Proceeds from divestment in other entities | Tiền thu hồi đầu tư góp vốn vào đơn vị khác | CF_DIVEST_OTH
Gain on Dividend | Tiền thu lãi cho vay, cổ tức và lợi nhuận được chia | CF_DIV_RECV
Net Cash Flows from Investing Activities | Lưu chuyển tiền thuần từ HĐ đầu tư | CFI
Increase in charter captial | Tiền thu từ phát hành cổ phiếu, nhận vốn góp | CF_ISSUE_SHARE
Payments for share repurchases | Tiền chi trả vốn góp, mua lại cổ phiếu | CF_REBUY_SHARE
Proceeds from borrowings | Tiền thu từ đi vay | CF_BORROW
Repayment of borrowings | Tiền trả nợ gốc vay | CF_REPAY_DEBT
Finance lease principal payments | Tiền trả nợ gốc thuê tài chính | CF_LEASE_PAY
Dividends paid | Cổ tức, lợi nhuận đã trả cho chủ sở hữu | CF_DIV_PAID
Cash flows from financial activities | Lưu chuyển tiền thuần từ HĐ tài chính | CFF
Net increase/decrease in cash and cash equivalents | Lưu chuyển tiền thuần trong kỳ | NET_CF
Cash and cash equivalents | Tiền và tương đương tiền đầu kỳ | CASH_BEGIN
Foreign exchange differences Adjustment | Ảnh hưởng của thay đổi tỷ giá | FX_ADJ
Cash and Cash Equivalents at the end of period | Tiền và tương đương tiền cuối kỳ | CASH_END
Interest income and dividends | Lãi tiền gửi và cổ tức | INT_DIV_INC
"""

# Name as loaded | standard name. Two raw names may share a standard name.
STANDARD_INDICATORS = """
Tiền và tương đương tiền | Tiền và tương đương tiền
Tiền và tương đương tiền đầu kỳ | Tiền và tương đương tiền đầu kỳ
Tiền và tương đương tiền cuối kỳ | Tiền và tương đương tiền cuối kỳ
Đầu tư tài chính ngắn hạn | Đầu tư tài chính ngắn hạn
Trading Securities | Chứng khoán kinh doanh
Trading Securities, net | Chứng khoán kinh doanh (ròng)
Provision for diminution in value of Trading Securities | Dự phòng giảm giá chứng khoán kinh doanh
Các khoản phải thu | Các khoản phải thu
Phải thu về cho vay ngắn hạn | Phải thu về cho vay ngắn hạn
Người mua trả tiền trước | Người mua trả tiền trước
Trả trước cho người bán | Trả trước cho người bán
Hàng tồn kho | Hàng tồn kho
Hàng tồn kho ròng | Hàng tồn kho ròng
Tài sản ngắn hạn khác | Tài sản ngắn hạn khác
Tài sản ngắn hạn khác (Bn) | Tài sản ngắn hạn khác
Tài sản ngắn hạn | Tổng tài sản ngắn hạn
Phải thu dài hạn của khách hàng | Phải thu dài hạn của khách hàng
Phải thu dài hạn khác | Phải thu dài hạn khác
Phải thu về cho vay dài hạn | Phải thu về cho vay dài hạn
Tài sản cố định | Tài sản cố định
Tangible fixed assets | Tài sản cố định hữu hình
Intagible fixed assets | Tài sản cố định vô hình
Leased assets | Tài sản thuê tài chính
Chi phí trả trước dài hạn | Chi phí trả trước dài hạn
Đầu tư tài chính dài hạn | Đầu tư tài chính dài hạn
Investment Securities | Chứng khoán đầu tư
Held-to-Maturity Securities | Chứng khoán nắm giữ đến ngày đáo hạn
Available-for Sales Securities | Chứng khoán sẵn sàng để bán
Balances with the SBV | Tiền gửi tại Ngân hàng Nhà nước
Less: Provision for diminution in value of investment securities | Dự phòng giảm giá chứng khoán đầu tư
Less: Provision for diminuation in value of long term investments | Dự phòng giảm giá đầu tư dài hạn
Investment in properties | Đầu tư bất động sản
Investment in joint ventures | Đầu tư vào công ty liên doanh
Investments in associate companies | Đầu tư vào công ty liên kết
Goodwill | Lợi thế thương mại
Lợi thế thương mại | Lợi thế thương mại
Tài sản dài hạn khác | Tài sản dài hạn khác
Tài sản dài hạn khác (Bn) | Tài sản dài hạn khác
Other Assets | Tài sản khác
Tài sản dài hạn | Tổng tài sản dài hạn
Tổng cộng tài sản | Tổng cộng tài sản
Nợ ngắn hạn | Nợ ngắn hạn
Vay và nợ ngắn hạn | Vay và nợ ngắn hạn
Deposits from customers | Tiền gửi khách hàng
Deposits and borrowings from other credit institutions | Tiền gửi và vay từ các tổ chức tín dụng khác
Placements with and loans to other credit institutions | Tiền gửi tại và cho vay các tổ chức tín dụng khác
Due to Gov and borrowings from SBV | Nợ Chính phủ và vay NHNN
Derivatives and other financial liabilities | Các công cụ phái sinh và nợ tài chính khác
_Derivatives and other financial liabilities | Các công cụ phái sinh và nợ tài chính khác
Nợ dài hạn | Nợ dài hạn
Vay và nợ dài hạn | Vay và nợ dài hạn
Convertible bonds (Bn. VND) | Trái phiếu chuyển đổi
Convertible bonds/CDs and other valuable papers issued | Trái phiếu chuyển đổi và giấy tờ có giá đã phát hành
Other liabilities | Nợ khác
Nợ phải trả | Tổng nợ phải trả
Dự phòng tổn thất tín dụng | Dự phòng tổn thất tín dụng
Loans and advances to customers | Cho vay khách hàng
Loans and advances to customers, net | Cho vay khách hàng (ròng)
Less: Provision for losses on loans and advances to customers | Dự phòng tổn thất cho vay khách hàng
Vốn chủ sở hữu | Vốn chủ sở hữu
Capital | Vốn góp
Vốn góp của chủ sở hữu | Vốn góp của chủ sở hữu
Cổ phiếu phổ thông | Cổ phiếu phổ thông
Vốn và các quỹ | Vốn và các quỹ
Reserves | Các quỹ dự trữ
Other Reserves | Quỹ khác
_Other Reserves | Quỹ khác
Quỹ đầu tư phát triển | Quỹ đầu tư phát triển
Foreign Currency Difference reserve | Quỹ dự trữ chênh lệch tỷ giá
Difference upon Assets Revaluation | Chênh lệch đánh giá lại tài sản
LNST chưa phân phối | Lợi nhuận sau thuế chưa phân phối
LNST của cổ đông công ty mẹ | Lợi nhuận sau thuế thuộc cổ đông công ty mẹ
Lợi ích cổ đông thiểu số | Lợi ích cổ đông thiểu số
Lợi ích cổ đông thiểu số (Nguồn vốn) | Lợi ích cổ đông thiểu số
Budget sources and other funds | Nguồn kinh phí và quỹ khác
Funds received from Gov, international and other institutions | Nguồn kinh phí đã hình thành tài sản cố định
Tổng cộng nguồn vốn | Tổng cộng nguồn vốn
Doanh thu | Doanh thu
Doanh thu bán hàng | Doanh thu bán hàng và cung cấp dịch vụ
Total operating revenue | Tổng doanh thu hoạt động
Các khoản giảm trừ doanh thu | Các khoản giảm trừ doanh thu
Doanh thu thuần | Doanh thu thuần
Giá vốn hàng bán | Giá vốn hàng bán
Lợi nhuận gộp | Lợi nhuận gộp về bán hàng và cung cấp dịch vụ
Chi phí bán hàng | Chi phí bán hàng
Chi phí quản lý doanh nghiệp | Chi phí quản lý doanh nghiệp
Khấu hao và hao mòn | Khấu hao và hao mòn
Doanh thu tài chính | Doanh thu hoạt động tài chính
Interest and Similar Income | Thu nhập lãi và thu nhập tương tự
Fees and Comission Income | Thu nhập phí và hoa hồng
Lãi tiền gửi và cổ tức | Lãi tiền gửi và cổ tức nhận được
Dividends received | Cổ tức nhận được
Chi phí tài chính | Chi phí hoạt động tài chính
Interest and Similar Expenses | Chi phí lãi và chi phí tương tự
Fees and Comission Expenses | Chi phí phí và hoa hồng
Chi phí lãi vay | Chi phí lãi vay
Chi phí lãi vay (Lưu chuyển tiền tệ) | Chi phí lãi vay
Net Interest Income | Thu nhập lãi thuần
Net Fee and Commission Income | Thu nhập phí và hoa hồng thuần
Lãi/lỗ từ hoạt động đầu tư | Lãi lỗ từ hoạt động đầu tư
Lãi/lỗ từ công ty liên doanh liên kết | Lãi lỗ từ công ty liên doanh, liên kết
Net income from associated companies | Thu nhập từ công ty liên kết
Net gain (loss) from disposal of investment securities | Lãi lỗ thuần từ thanh lý chứng khoán đầu tư
Net gain (loss) from foreign currency and gold dealings | Lãi lỗ thuần từ hoạt động kinh doanh ngoại tệ và vàng
Net gain (loss) from trading of trading securities | Lãi lỗ thuần từ mua bán chứng khoán kinh doanh
Profit/Loss from disposal of fixed assets | Lãi lỗ từ thanh lý tài sản cố định
Thu nhập khác | Thu nhập khác
Other expenses | Chi phí khác
Thu nhập/Chi phí khác | Thu nhập chi phí khác
Lợi nhuận khác | Lợi nhuận khác
Profits from other activities | Lợi nhuận từ hoạt động khác
Net Other income/(expenses) | Thu nhập khác thuần
Net Other income/expenses | Thu nhập khác thuần
Lợi nhuận từ HĐKD | Lợi nhuận từ hoạt động kinh doanh
Lợi nhuận từ HĐKD trước thay đổi vốn lưu động | Lợi nhuận từ hoạt động kinh doanh trước thay đổi vốn lưu động
Operating Profit before Provision | Lợi nhuận hoạt động trước trích lập dự phòng
Lãi/lỗ chênh lệch tỷ giá chưa thực hiện | Lãi lỗ chênh lệch tỷ giá chưa thực hiện
Ảnh hưởng của thay đổi tỷ giá | Ảnh hưởng của thay đổi tỷ giá hối đoái
Lợi nhuận trước thuế | Tổng lợi nhuận kế toán trước thuế
Lợi nhuận/Lỗ thuần trước thuế | Lợi nhuận thuần trước thuế
Tax For the Year | Chi phí thuế thu nhập doanh nghiệp
Thuế TNDN hiện hành | Chi phí thuế TNDN hiện hành
Thuế TNDN hoãn lại | Chi phí thuế TNDN hoãn lại
Lợi nhuận sau thuế thu nhập DN | Lợi nhuận sau thuế thu nhập doanh nghiệp
LNST phân bổ cho CĐ công ty mẹ | Lợi nhuận sau thuế thuộc cổ đông công ty mẹ
EPS_basis | Lãi cơ bản trên cổ phiếu
Tăng trưởng doanh thu YoY | Tăng trưởng doanh thu so với cùng kỳ
Tăng trưởng LNST mẹ YoY | Tăng trưởng lợi nhuận sau thuế công ty mẹ so với cùng kỳ
Net Cash Flows from Operating Activities before BIT | Lưu chuyển tiền thuần từ hoạt động kinh doanh trước thuế
Tăng/Giảm các khoản phải thu | Tăng giảm các khoản phải thu
_Increase/Decrease in receivables | Tăng giảm các khoản phải thu
Tăng/Giảm hàng tồn kho | Tăng giảm hàng tồn kho
Tăng/Giảm chi phí trả trước | Tăng giảm chi phí trả trước
Tăng/Giảm các khoản phải trả | Tăng giảm các khoản phải trả
_Increase/Decrease in payables | Tăng giảm các khoản phải trả
Other receipts from operating activities | Tiền thu khác từ hoạt động kinh doanh
Other payments on operating activities | Tiền chi khác từ hoạt động kinh doanh
Tiền lãi vay đã trả | Tiền lãi vay đã trả
Thuế TNDN đã nộp | Thuế thu nhập doanh nghiệp đã nộp
Lưu chuyển tiền thuần từ HĐKD | Lưu chuyển tiền thuần từ hoạt động kinh doanh
Tiền chi mua sắm TSCĐ | Tiền chi để mua sắm xây dựng tài sản cố định
Tiền thu thanh lý TSCĐ | Tiền thu từ thanh lý nhượng bán tài sản cố định
Tiền chi đầu tư góp vốn vào đơn vị khác | Tiền chi đầu tư góp vốn vào đơn vị khác
Tiền thu hồi đầu tư góp vốn vào đơn vị khác | Tiền thu hồi đầu tư góp vốn vào đơn vị khác
Tiền cho vay, mua công cụ nợ | Tiền chi cho vay mua các công cụ nợ của đơn vị khác
Tiền thu hồi cho vay, bán công cụ nợ | Tiền thu hồi cho vay bán lại các công cụ nợ của đơn vị khác
Tiền thu lãi cho vay, cổ tức và lợi nhuận được chia | Tiền thu lãi cho vay cổ tức và lợi nhuận được chia
Lưu chuyển tiền thuần từ HĐ đầu tư | Lưu chuyển tiền thuần từ hoạt động đầu tư
Tiền thu từ phát hành cổ phiếu, nhận vốn góp | Tiền thu từ phát hành cổ phiếu nhận vốn góp của chủ sở hữu
Tiền chi trả vốn góp, mua lại cổ phiếu | Tiền chi trả vốn góp cho các chủ sở hữu mua lại cổ phiếu
Tiền thu từ đi vay | Tiền thu từ đi vay
Tiền trả nợ gốc vay | Tiền trả nợ gốc vay
Tiền trả nợ gốc thuê tài chính | Tiền trả nợ gốc thuê tài chính
Cổ tức, lợi nhuận đã trả cho chủ sở hữu | Cổ tức lợi nhuận đã trả cho chủ sở hữu
Payment from reserves | Chi từ các quỹ
Lưu chuyển tiền thuần từ HĐ tài chính | Lưu chuyển tiền thuần từ hoạt động tài chính
Lưu chuyển tiền thuần trong kỳ | Lưu chuyển tiền thuần trong kỳ
"""

# Fixed value: a character outside this class makes a name "special". The part ``,-/``
# is a range, so the full stop is inside.
SPECIAL_CHARACTERS = (
    "[^a-zA-Z0-9ÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚĂĐĨŨƠàáâãèéêìíòóôõùúăđĩũơƯĂẠẢẤẦẨẪẬẮẰẲẴẶẸẺẼỀỀỂưăạảấầẩẫậắằẳẵặẹẻẽềềểỄỆỈỊỌỎỐỒỔỖỘỚỜỞỠỢỤỦỨỪễệỉịọỏốồổỗộớờởỡợụủứừỬỮỰỲỴÝỶỸửữựỳỵýỷỹ (),-/]"
)

# The market indices followed, and the first day of their series.
INDEX_SYMBOLS = ("VNINDEX", "HNXINDEX", "UPCOMINDEX", "VN30", "HNX30")
INDEX_START = "2026-01-01"

# Default first day of price and macro series.
PRICE_START = "2008-01-01"
MACRO_START = "2000-01-01"

# Macro series -> (tag column, tag).
MACRO_SERIES = {
    "us_bond_10y": ("indicator_type", "US_BOND_10Y"),
    "usd_vnd": ("indicator_type", "USD_VND"),
    "dxy_index": ("indicator_type", "DXY_INDEX"),
    "usd_cny": ("indicator_type", "USD_CNY"),
    "eur_usd": ("indicator_type", "EUR_USD"),
    "xau": ("asset_type", "GOLD"),
    "oil": ("asset_type", "OIL"),
    "dowjone": ("asset_type", "DOWJONES"),
}

# Statement kind -> report code.
STATEMENTS = {"income_statement": "IS", "balance_sheet": "BL", "cash_flow": "CF"}

# Object keys of the lake, as jobs and reports name outputs. ``lake.written_keys`` gives them for
# the batches that ``write_lake`` left.
LAYOUTS = {
    "history_price": "history_price/{ds}/batch_{batch}.csv",
    "daily_price": "daily_price/{ds}/batch_{batch}.csv",
    "index_price": "index_price/{ds}/index_price_{ts}.csv",
    "financial_ratios": "financial_ratios/{ds}/batch_{batch}.csv",
    "bctc": "bctc/{ds}/batch_{batch}.csv",
    "overview": "overview/date={ds}/batch_{batch}.csv",
    "people": "people/date={ds}/batch_{batch}.csv",
    "global_index": "global_index/{series}/{ds}/data.csv",
    "commodity": "{series}/{ds}/data.csv",
    "news_daily": "news/daily/{ds}/news_daily_{ts}.csv",
    "news_site": "news/site/{ds}/news_site_{ts}.csv",
}


def rows(table: str) -> list[tuple[str, ...]]:
    """Rows of one of the ``|`` separated tables above."""
    return [tuple(part.strip() for part in line.split(" | ")) for line in table.strip().splitlines()]
