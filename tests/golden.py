"""Literal rows with known totals, for tests only."""

# Users, products, prices by sku, orders.
USERS = [
    ("u001", "田中 太郎", "東京"), ("u002", "山田 花子", "大阪"), ("u003", "佐藤 健", "愛知"),
    ("u004", "鈴木 恵", "福岡"), ("u005", "高橋 誠", "北海道"), ("u006", "伊藤 めぐみ", "東京"),
    ("u007", "渡辺 拓哉", "神奈川"), ("u008", "中村 さくら", "大阪"), ("u009", "小林 竜", "愛知"),
    ("u010", "加藤 玲奈", "東京"), ("u011", "吉田 浩", "福岡"), ("u012", "山本 綾", "兵庫"),
    ("u013", "松本 隆", "京都"), ("u014", "井上 みき", "埼玉"), ("u015", "木村 剛", "千葉"),
]
PRODUCTS = [
    ("A001", "Trail Shoes", "Sports"), ("A002", "Yoga Mat", "Sports"),
    ("A003", "Running Cap", "Sports"), ("B001", "Coffee Beans", "Food"),
    ("B002", "Protein Bar", "Food"), ("B003", "Green Tea", "Food"), ("C001", "Desk Lamp", "Home"),
    ("C002", "Candle Set", "Home"), ("C003", "Air Purifier", "Home"),
    ("D001", "USB Hub", "Electronics"), ("D002", "Webcam", "Electronics"),
    ("D003", "Bluetooth Speaker", "Electronics"), ("E001", "Cotton Tote", "Fashion"),
    ("E002", "Wool Scarf", "Fashion"), ("E003", "Leather Wallet", "Fashion"),
]
PRICES = {
    "A001": 12000, "A002": 4800, "A003": 2500, "B001": 900, "B002": 350, "B003": 600,
    "C001": 4500, "C002": 2800, "C003": 18000, "D001": 3200, "D002": 8500, "D003": 12000,
    "E001": 1500, "E002": 3600, "E003": 6800,
}
ORDERS = [
    ("o1001", "u001", "2025-12-03"), ("o1002", "u002", "2025-12-07"),
    ("o1003", "u003", "2025-12-10"), ("o1004", "u004", "2025-12-14"),
    ("o1005", "u005", "2025-12-18"), ("o1006", "u001", "2025-12-22"),
    ("o1007", "u006", "2025-12-25"), ("o1008", "u007", "2025-12-28"),
    ("o1009", "u002", "2026-01-05"), ("o1010", "u008", "2026-01-09"),
    ("o1011", "u003", "2026-01-13"), ("o1012", "u009", "2026-01-17"),
    ("o1013", "u001", "2026-01-20"), ("o1014", "u010", "2026-01-24"),
    ("o1015", "u004", "2026-01-28"), ("o1016", "u011", "2026-02-03"),
    ("o1017", "u002", "2026-02-07"), ("o1018", "u012", "2026-02-12"),
    ("o1019", "u001", "2026-02-18"), ("o1020", "u013", "2026-02-25"),
]
# Order, sku, quantity, price.
ORDER_ITEMS = [
    ("o1001", "A001", 1, 12000),
    ("o1001", "B001", 2, 900),
    ("o1002", "C001", 1, 4500),
    ("o1002", "B002", 3, 350),
    ("o1003", "D001", 1, 3200),
    ("o1003", "E001", 2, 1500),
    ("o1004", "A002", 1, 4800),
    ("o1004", "B003", 2, 600),
    ("o1005", "C002", 1, 2800),
    ("o1005", "D002", 1, 8500),
    ("o1006", "A001", 1, 12000),
    ("o1006", "E002", 1, 3600),
    ("o1007", "B001", 3, 900),
    ("o1007", "C003", 1, 18000),
    ("o1008", "D003", 1, 12000),
    ("o1008", "A003", 2, 2500),
    ("o1009", "E003", 1, 6800),
    ("o1009", "B002", 2, 350),
    ("o1010", "C001", 1, 4500),
    ("o1010", "A002", 1, 4800),
    ("o1011", "D001", 2, 3200),
    ("o1011", "B003", 3, 600),
    ("o1012", "E001", 1, 1500),
    ("o1012", "A003", 2, 2500),
    ("o1013", "C002", 2, 2800),
    ("o1013", "B001", 1, 900),
    ("o1014", "D002", 1, 8500),
    ("o1014", "E002", 1, 3600),
    ("o1015", "A001", 1, 12000),
    ("o1015", "C003", 1, 18000),
    ("o1016", "B002", 4, 350),
    ("o1016", "D001", 1, 3200),
    ("o1017", "E003", 1, 6800),
    ("o1017", "A002", 2, 4800),
    ("o1018", "C001", 1, 4500),
    ("o1018", "B003", 2, 600),
    ("o1019", "D003", 1, 12000),
    ("o1019", "E001", 3, 1500),
    ("o1020", "A003", 1, 2500),
    ("o1020", "C002", 1, 2800),
]
# Event, user, time, system, version, review, items as (sku, quantity).
EVENTS = [
    ("e001", "u001", "2026-02-01T09:00:00Z", "iOS", "2.0.0",
     "Fast delivery and good quality. I would buy again.", [("A001", 1), ("B001", 2)]),
    ("e002", "u002", "2026-02-01T11:30:00Z", "Android", "2.1.0",
     "Coffee aroma was strong, but the packaging was slightly damaged.", [("B001", 3)]),
    ("e003", "u003", "2026-02-02T14:15:00Z", "PC", "2.0.1", None, [("C001", 1), ("D001", 1)]),
    ("e004", "u001", "2026-02-03T10:00:00Z", "iOS", "2.0.0",
     "Exactly as described. Will order again.", [("A002", 1)]),
    ("e005", "u004", "2026-02-04T16:45:00Z", "Android", "1.2.0", None, [("E001", 2)]),
    ("e006", "u002", "2026-02-05T09:30:00Z", "Android", "2.1.0",
     "Good value for money. Quick delivery.", [("B002", 5), ("B003", 2)]),
    ("e007", "u005", "2026-02-06T20:00:00Z", "iOS", "2.0.1",
     "The speaker quality exceeded my expectations.", [("D003", 1)]),
    ("e008", "u003", "2026-02-07T13:20:00Z", "PC", "2.0.1", None, [("C003", 1), ("A003", 2)]),
]
REVIEWS = [
    ("r001", "u001", "配送がとても速く、品質も申し分ありませんでした。シューズはトレイルランニングに最適で快適に使えました。"),
    ("r002", "u002", "コーヒーの香りは素晴らしかったですが、パッケージが少し破損した状態で届きました。"),
    ("r003", "u003", "商品自体は概ね問題ありませんでしたが、セットアップの説明書がわかりにくく困りました。"),
]


def order_items():
    return list(ORDER_ITEMS)


def documents():
    names = {sku: (name, category) for sku, name, category in PRODUCTS}
    out = []
    for event, user, moment, system, version, review, items in EVENTS:
        document = {
            "event_id": event, "user_id": user, "event_type": "purchase", "event_time": moment,
            "device": {"os": system, "app_version": version},
            "items": [
                {"sku": sku, "product_name": names[sku][0], "category": names[sku][1],
                 "qty": qty, "price": PRICES[sku]} for sku, qty in items],
        }
        if review:
            document["review_text"] = review
        out.append(document)
    return out
