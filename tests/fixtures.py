"""A handful of order events in the shape the order service sends."""

import json


def event(order_id, lines, paid=True, shipping=True, **change):
    """One event with amounts computed as the service does, in floats rounded per step."""
    subtotal = off = 0.0
    details = []
    for i, (product, quantity, price, percent) in enumerate(lines):
        whole = round(price * quantity, 2)
        cut = round(whole * (percent / 100), 2)
        subtotal += round(whole - cut, 2)
        off += cut
        details.append(
            {
                "OrderDetailID": order_id * 10 + i,
                "OrderID": order_id,
                "ProductID": product,
                "Quantity": quantity,
                "UnitPrice": price,
                "Discount": percent,
            }
        )
    subtotal, off = round(subtotal, 2), round(off, 2)
    tax, cost = round(subtotal * 0.14, 2), 50.0 if shipping else 0.0
    amount = round(subtotal + tax + cost, 2)
    status = "Cancelled" if not paid else "Confirmed" if shipping else "Processing"
    shipment = {
        "ShipmentID": order_id,
        "OrderID": order_id,
        "ShipperID": 3,
        "ShipDate": "2026-09-23",
        "DeliveryDate": "2026-09-26",
    }
    document = {
        "metadata": {
            "event_id": f"e{order_id}",
            "event_type": "ORDER_CREATED",
            "event_timestamp": "2026-09-22T13:44:22.778852+00:00",
            "source": "shop",
        },
        "order": {
            "OrderID": order_id,
            "CustomerID": 1000 + order_id % 7,
            "OrderDate": "2026-09-22",
            "Status": status,
        },
        "order_details": details,
        "payment": {
            "PaymentID": order_id,
            "OrderID": order_id,
            "PaymentMethod": "Credit Card",
            "PaymentDate": "2026-09-22",
            "Amount": amount,
            "PaymentStatus": "Completed" if paid else "Failed",
        },
        "shipment": shipment if paid and shipping else None,
        "summary": {
            "subtotal": subtotal,
            "discount": off,
            "tax_rate": 0.14,
            "tax_amount": tax,
            "shipping_cost": cost,
            "total_amount": amount,
        },
    }
    return document | change


EVENTS = [
    event(2000001, [(1, 2, 414.31, 0.0), (2, 3, 463.51, 5.0)]),
    event(2000002, [(1, 1, 0.5, 15.0)], paid=False),
    event(2000003, [(3, 7, 99.99, 10.0), (4, 1, 10.0, 5.0), (5, 2, 3.33, 15.0)], shipping=False),
    event(2000004, []),
]


def write_documents(folder, documents):
    """One pretty-printed file per document, as the service stores them."""
    folder.mkdir(parents=True, exist_ok=True)
    for i, d in enumerate(documents):
        text = d if isinstance(d, str) else json.dumps(d, indent=4)
        name = f"doc_{len(list(folder.iterdir()))}_{i}.json"
        (folder / name).write_text(text)
    return str(folder)


def rows(df, *order):
    """Rows as plain tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
