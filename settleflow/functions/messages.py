"""Texts shown to the users. Reports and follow-up jobs match on them."""

# billing reconciliation
AMOUNT_NOT_BILLED = "ยอด บ.ส. ไม่เท่ากับ ยอดวางบิล"
AMOUNT_AND_BILL_ZERO = "ยอด บ.ส. และยอดวางบิลเป็น 0"
TRANSFER_NOT_AMOUNT_NPL = "ยอดโอนเงิน ไม่เท่ากับ (ยอด บ.ส. + ยอด NPL)"

# amount validation
TRANSFER_DIFFERS = "ยอด บ.ส.ไม่เท่ากับยอดโอน"
NO_POLICY = "ไม่มีเลขที่กรมธรรม์"
CHECK_POLICY_STATUS = "ตรวจสอบสถานะกรมธรรม์"
AMOUNT_WRONG = "ยอดเงินตาม บ.ส.ไม่ถูกต้อง"
PAYMENT_RUNNING = "บ.ส.นี้อยู่ระหว่างดำเนินการโอนเงิน"
ONLINE_CANCELLED = "สถานะ ClaimOnline ยกเลิก"

# batch import
TWICE_IN_FILE = "รายการ บ.ส. ซ้ำกันในไฟล์"
ALREADY_IMPORTED = "รายการ บ.ส. ซ้ำกับในระบบ"
NOT_FOUND = "ไม่พบเลข บ.ส. นี้ในฐานข้อมูล"
COUNT_DIFFERS = "ข้อมูลจำนวนเคลมไม่ตรงกับในฐานข้อมูล"
NO_AMOUNT = "ไม่มียอดเงินในรายการ บ.ส."
AMOUNT_DIFFERS = "ข้อมูลจำนวนเงินรวมไม่ตรงกับในฐานข้อมูล"
CLAIM_ALREADY_IN = "มีรายการเคลมนี้ในระบบแล้ว"
WRONG_GROUP = "รายการ บ.ส. นี้ ไม่ใช่กลุ่ม"
OF_GIVEN_GROUP = "ตามกลุ่มที่ระบุ"
NO_DOCUMENTS = "บ.ส. ไม่มีเอกสารแนบ"
CLAIM_WITHOUT_DOCUMENT = "ไม่พบเอกสารแนบ"
NO_CLAIM_TYPE = "ไม่ได้ MappingType (H,C)"
MUST_HAVE = " ต้องมี "
POLICY_HISTORY = "ประวัติการบันทึกกรมธรรม์ >> "
CHECK_FUND_CLAIM = "ตรวจสอบรายการเคลมกองทุนรถม้าลาย"
MISC_GROUP = "เบ็ดเตล็ด"
HOSPITAL_CLAIM, CUSTOMER_CLAIM = "เคลมโรงพยาบาล", "เคลมลูกค้า"
IMPORTED_FROM_FILE = "Import บ.ส. เรียบร้อย อยู่ระหว่างรอการ Generate Group วางบิล"
IMPORTED_FROM_LIST = "ได้รับข้อมูล บ.ส. เรียบร้อย อยู่ระหว่างรอการ Generate Group วางบิล"

# transfers
UNKNOWN_ENTRY = "กรุณาตรวจสอบ รายการที่ส่งมา เนื่องจากไม่มีข้อมูลในระบบ"
PARTLY_TRANSFERRED = "กรุณาตรวจสอบรายการ เนื่องจากมีบางรายการโอนเงินเรียบร้อยแล้ว"
ALREADY_TRANSFERRED = "กรุณาตรวจสอบ เนื่องจากมีการโอนเงินเรียบร้อยแล้ว"
TRANSFER_AMOUNT_WRONG = "กรุณาตรวจสอบ จำนวนเงินที่โอน เนื่องจากยอดเงินไม่ตรงกับในระบบ"
TRANSFER_TIME_MISSING = "กรุณาตรวจสอบ เวลาโอนเงิน"
ABOVE_LIMIT = "กรุณาตรวจสอบ เนื่องจาก ยอดเงิน CPBG มากกว่า "
HOSPITAL_ONLY = "ต้องเป็นเคลมโรงพยาบาลเท่านั้น"

# manual cover entries
INCOMPLETE = "กรุณากรอกข้อมูลให้ครบถ้วน"
NO_IMPORTED_CLAIM = "ยังไม่มีรายการ Claim Import"
ALREADY_BILLED = "มีการ BillingRequestGroup แล้ว"
NOT_EDITABLE = "ห้ามแก้ไข"
NO_UPDATE = "ห้าม Update"
VALUE_UNCHANGED = "ข้อมูลที่แก้ไขต้องไม่ตรงกับค่าเดิม"
CHECK_AMOUNT = "กรุณาตรวจสอบยอดเงิน"

# insurer results
APPROVED = "อนุมัติ"
PARTLY_APPROVED = "อนุมัติบางส่วน"
