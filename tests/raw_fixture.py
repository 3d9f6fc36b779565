"""Small exports, every value of them made up, with the kinds of quirk the readers must bear."""

from __future__ import annotations

import json
import os
from datetime import datetime

AS_OF = datetime(2024, 5, 20, 9, 30)

FILES = {
    "users/users_store.csv": """crm_id,name,tel,email_address,created_local,store_code,status,source
a1,MIRA KOSTA,61355500101.0,mira@kosta.test,03/05/2024 11:25,BNE07,Active,Store
a2,Tom Udal,61355500102.0,,06/05/2024 09:05,PER02,Active,Store
K-77,"Odo, the 3rd",+61355500103,odo@harbour.test,2024-05-11 16:42:08,BNE07,Prospect,store
a4,Ivy Pell,,,09/05/2024 13:37,BNE07,Active,Store
a5,Mira Kosta,61355500101.0,MIRA@kosta.test,02/05/2024 11:25,BNE07,Active,Store
""",
    "users/users_website.csv": """user_id,email,phone_number,full_name,created_at,updated_at,marketing_opt_in,source
m1,mira@kosta.test,61355500109.0,Mira Kosta,2024-05-01T00:00:00.000007Z,2024-05-12T08:03:17.250001Z,,Website
m2,tom@udal.test,+61355500102,Tom Udal,2024-05-08T00:00:00Z,2024-05-08T04:11:26Z,False,Website
m3,,+447700900321,,2024-05-13 22:18:40,2024-05-13 22:18:40,n,website
m4,lin@quay.test,+85255501234,Lin Quay,2024-05-13 22:18:40,2024-05-13 22:18:40,True,website
""",
    "orders/orders_store.csv": """txn_id,time_local,crm_id,sku,units,gross_amount_aud,status,payment_method,source
T51,03/05/2024 08:12,a1,SYD901,2,212.50,PAID,cash,Store
T52,07/05/2024 19:20,a2,QB77,1,88.30,VOID,card,Store
T53,01/04/2024 19:20,a9,QB77,1,41.49,PAID,card,Store
""",
    "orders/orders_website.csv": """order_id,order_ts,user_id,product_id,qty,total,currency,status,source
E81,2024-05-06T07:45:12.000123Z,m1,TAS902,3,130.05,AUD,Cancelled,Website
E82,2024-05-10T21:30:05.640000Z,m2,NV33,3,256.40,AUX,Completed,Website
E83,2024-05-10T21:30:05.640000Z,m4,,1,2.00,cny,Completed,Website
""",
    "orders/orders_ota.csv": """bookingRef,bookingDate,customerEmail,productCode,pax,amount,currency,bookingStatus,source
B61,2024-05-20T11:02:33+00:00+11:00, MIRA@kosta.test ,NV-33,1,AUD 77.80,AUD,Success,OTA
B62,2024-05-14T15:18:59+00:00+11:00,ghost@nowhere.test,SYD-901,1,HKD 93.00,AUD,Refund,OTA
B63,2024-05-14T06:44:21+00:00+11:00,lin@quay.test,nv-35,1,149.61,AUD,Success,OTA
""",
    "inventory/inventory_store.csv": """sku,stock_level,price,currency,last_sync_local,source
NV33,3,64.25,AUD,20/05/2024 09:24,Store
NV33,11,70.10,AUD,20/05/2024 05:50,Store
QB77,6,55.00,AUD,20/05/2024 08:45,Store
QB77,4,55.00,AUD,20/05/2024 08:45,Store
""",
    "inventory/inventory_partner.csv": """partner_product_id,product_id,QTY_AVAILABLE,PRICE_AUD,LAST_PUSH_EPOCH,source
X1,NV33,9,A$64.25,1716197000,Partner
X2,QB77,4,55.00,1716020000,Partner
""",
}

OTA_STOCK = [
    {"productCode": "NV-33", "availability": 3, "price": "$64.25", "currency": "aud",
     "lastUpdate": "2024-05-20T09:24:10.120005Z", "source": "OTA"},
    {"productCode": "QB-77", "availability": "4", "price": 55.0, "currency": "AUD",
     "lastUpdate": "2024-05-20T09:14:30.7Z", "source": "OTA"},
    {"productCode": "SYD-901", "availability": 0, "price": None, "currency": "AUD",
     "lastUpdate": None, "source": "OTA"},
]


def write_raw(root: str, whatsapp: bool = False) -> str:
    files = {**FILES, "inventory/inventory_ota.json": json.dumps(OTA_STOCK, indent=2)}
    if whatsapp:
        users = [{"wa_id": "q9", "name": "pia ro", "phone": "+61355500177", "last_seen": "2024-05-02 00:00:00"}]
        files["users/users_whatsapp.json"] = json.dumps(users, indent=2)
    for path, text in files.items():
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "w") as f:
            f.write(text)
    return root
