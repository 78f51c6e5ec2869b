"""The patterns and word lists that decide results. They must stay as they are."""

# states of a tender
STATE_DROP = r"desierta|cancelada|revocada|suspendida|sin ofertas"
STATE_KEEP = r"adjudicada|publicada|cerrada"
STATE_OPENED = r"adjudicada|cerrada"

# scope of a tender
TENDER_IN = r"comput|notebook|laptop|port[aá]til|escritorio|all.?in.?one|\baio\b|workstation|servidor|equipamiento\s+comput|equipos?\s+comput|monitor|impresora|desktop|pc\b"
TENDER_OUT = r"\btablet|\bipad|arriendo|renovaci[oó]n\s+de\s+garant|servicio\s+de\s+mantenc|solo\s+tinta|\btoner\b\s*$|cartucho\s*$"

# scope of a product
EQUIPMENT = r"notebook|laptop|port[aá]til|ultrabook|chromebook|all.?in.?one|\baio\b|desktop|escritorio|\bpc\b|computador(?:a)?|workstation|thinkcentre|thinkstation|thinkpad|thinkbook|prodesk|elitedesk|optiplex|latitude|pavilion|macbook|mac\s*mini|imac|ideapad|ideacentre|vivobook|zenbook|expertbook|expertcenter|zbook|elitebook|probook|proone|eliteone|vostro|inspiron|veriton|aspire|travelmate|surface\s+(?:laptop|pro)|\bloq\b|\bvictus\b|\bomen\b"
TELEVISION = r"\b(?:smart\s*)?t\.?v\.?\b|televisor"
OUT_OF_SCOPE = r"proyector|tablet|\btab\s+one\b|android|ipad|celular|smartphone|servidor|\bservers?\b|thinksystem|poweredge|proliant|uniserver|storage|switch|router|access point|\bred\b|rack|cable|teclado|mouse|rat[oó]n|docking|dock|base de expansi[oó]n|tinta|t[oó]ner|cartucho|tambor|repuesto|licencia|instalaci[oó]n|servicio"
ACCESSORY_FIRST = r"^\W*(?:n.?\s*\d+\s+)?(?:\d+\W+)?(?:estuche|funda|malet[ií]n|mochila|bolso|cargador|adaptador|protector|l[aá]mina|soporte|base\s+refrigerante|candado|hub|kit|lic(?:encia|ense)|renovaci[oó]n|extensi[oó]n\s+de\s+garant[ií]a|garant[ií]a)\b"
PERIPHERAL_FIRST = r"^\W*(?:carro|carrito|esc[aá]ner|scanner|ups\b|webcam|c[aá]mara|concentrador|parlante|aud[ií]fono|pizarra|lector\s+de\s+(?:c[oó]digo|barra|tarjeta)|gabinete|estaci[oó]n\s+de\s+carga|bater[ií]a|fuente\s+de\s+poder)"
ACCESSORY_HEAD = r"malet[ií]n|mochila|bolso|funda|estuche|cargador|adaptador|\bups\b|carro\s+(?:de\s+)?(?:carga|transporte|tecnol)"
SOFTWARE = r"subscription|suscripci[oó]n|\bsaas\b|per\s+device|por\s+dispositivo"
MONITOR = r"monitor|display"
PRINTER = r"impresora|multifuncional|plotter"
SPECIFICATION = r"procesador|cpu|\bram\b|memoria(?:\s+(?:ram|ddr))?|\bssd\b|\bhdd\b|disco(?:\s+duro)?|puertos?|conectividad|sistema operativo|windows|fuente de poder|garant[ií]a|servicio|instalaci[oó]n|configuraci[oó]n|servidor|storage|switch|router|access point|\bred\b|cable|rack"
LABOUR_FIRST = r"^\W*(?:armado|ensamblaje|instalaci[oó]n|configuraci[oó]n)\b"

# equipment types, in the order in which they are tried
TYPE_PATTERNS = (
    ("all-in-one", r"all.?in.?one|\baio\b|todo.{0,2}en.{0,2}uno|pro\s?one|elite\s?one|\bimac\b|pavilion\s+\d{2}-|\b\d{2}-cr\d"),
    ("workstation", r"workstation|estaci[oó]n\s+de\s+trabajo|thinkstation|\bz[248]\s+g\d"),
    ("notebook", r"notebook|laptop|port[aá]til|ultrabook|chromebook|macbook|probook|elitebook|zbook|thinkpad|thinkbook|ideapad|latitude|vostro|vivobook|zenbook|expertbook|travelmate|\b1[45]-[a-z]{2}\d"),
    ("desktop", r"desktop|escritorio|\btorre\b|\bpc\b|\bsff\b|mini\s*pc|prodesk|elitedesk|optiplex|thinkcentre|veriton|expertcenter|mac\s*mini|computador"),
)
TYPES = ("notebook", "all-in-one", "desktop", "workstation", "monitor", "impresora")
TYPE_ALIASES = {
    "laptop": "notebook", "portatil": "notebook", "ultrabook": "notebook", "chromebook": "notebook",
    "aio": "all-in-one", "all in one": "all-in-one", "allinone": "all-in-one", "todo en uno": "all-in-one",
    "pc": "desktop", "torre": "desktop", "computador": "desktop", "mini pc": "desktop", "sff": "desktop",
    "escritorio": "desktop", "estacion de trabajo": "workstation", "multifuncional": "impresora",
    "printer": "impresora", "pantalla": "monitor",
}
STRONG_PRINTER = r"impresora|multifuncional|printer|eco\s?tank|smart\s?tank|laserjet|deskjet|officejet|workforce|inkjet|plotter|t[oó]ner|tinta"
PRINTER_BRANDS = ("epson", "brother", "canon", "ricoh", "kyocera", "xerox", "lexmark", "zebra", "pantum", "konica minolta", "sharp", "oki")

# brands
BRANDS = ("HP", "Lenovo", "ASUS", "Dell", "Apple", "Acer", "Samsung", "LG", "Epson", "Brother", "Canon", "MSI", "ViewSonic", "Xiaomi", "Sony", "Kyocera", "Ricoh", "Xerox", "Lexmark", "AOC", "Philips", "Gigabyte", "Huawei", "Logitech", "Zebra", "OZXEN", "Microsoft Surface")
BRAND_ALIASES = {"hewlett packard": "HP", "hewlett-packard": "HP", "hp inc": "HP", "hp inc.": "HP", "hewlett packard enterprise": "HP", "ozxen by exact": "OZXEN", "ozxen by exact s.a.": "OZXEN"}
NOT_BRANDS = ("intel", "amd", "nvidia", "qualcomm", "microsoft", "windows", "n/a", "na", "null", "none", "no aplica", "sin marca", "no especificada", "no especificado", "generica", "generico", "no indica", "s/m")
GENERIC_BRAND = r"^(?:(?:marca\s+)?(?:generic[oa]?s?|sin marca|no (?:indica|especifica)\w*))$"

# pages and lines
TECHNICAL_IDENTITY = r"\b(?:marca|modelo)\s*(?::|\||=)|\b(?:brand|model)\s*:"
TECHNICAL_DETAIL = r"procesador|\bram\b|\bssd\b|\bhdd\b|resoluci[oó]n|pulgadas|\b(?:ddr[345]|hdmi|displayport)\b"
AMOUNT = r"\$\s*[\d.]|\b\d{1,3}(?:\.\d{3})+(?:,\d+)?\b"
NUMBER = r"\d+(?:[.,]\d+)*"
NUMBER_IN_TEXT = r"\d[\d.,]*"
PRICE_WORD = r"precio|valor|unitario|total|neto|subtotal|monto"
GENERIC_EQUIPMENT = r"\bequipos?\b"
PRODUCT_LINE = r"notebook|computador|laptop|all.?in.?one|\baio\b|desktop|monitor|impresora|workstation|servidor|pc\b|equipo|modelo|procesador|ryzen|core\s*i[3579]|\bram\b|ssd|hdd|pulgadas|\bgb\b"
PRICE_LINE = r"precio|valor|unitario|cantidad|subtotal|total|neto|iva|\$\s*[\d.]|\b\d{1,3}(?:\.\d{3})+(?:,\d+)?\b"
TOTALS_ROW = r"\b(?:total|neto|iva|bruto|impuestos?|subtotal)\b"
NUMERIC_CELL = r"^\s*(?:CLP)?\s*\$?\s*[\d.,]+(?:\.-|-)?\s*(?:CLP)?\s*$"
SHORT_WORDS = ("de", "el", "la", "en", "un", "y", "a", "o", "e", "al", "se", "su", "es", "no", "lo", "por", "con", "los", "las", "del", "una", "que", "si", "ni", "ml", "kg", "gb", "tb", "hp", "pc", "tv", "lg", "ia", "uf", "iva")

# documents, by words in their folded names
ECONOMIC_NAME = r"econom|cotiza|presupuesto|precio"
TECHNICAL_NAME = r"tecnic|ficha|especific|producto"
GENERIC_DESCRIPTION = r"\btipo\s*\d|\bl[ií]nea\s*\d|^(?:notebooks?|computador(?:es)?|impresoras?|monitor(?:es)?|all in one|equipos?)$"

# prices in pesos
PRICE_LEAST, PRICE_MOST = 20_000, 20_000_000
PRICE_MOST_BY_TYPE = {"all-in-one": 6_000_000, "notebook": 8_000_000, "desktop": 9_000_000, "monitor": 3_500_000, "impresora": 9_000_000}
OFFER_LEAST = 50_000

# parts of alerts that decide the state of a product
INCONSISTENT = r"invalida|fuera_de_rango|no_aparece|repetido_en_otra|no_coincide|supera_total|conflicto_entre_fuentes|total_general"
INCOMPLETE = r"no_identificad"
SUSPECT = r"invalida|fuera_de_rango|no_aparece|repetido_en_otra|no_coincide|conflicto_entre_fuentes|total_general"

#: Names and contents of documents of past sales.
HISTORY_NAME = r"experiencia|comprobante|curr[ií]culum|referencias?|orden[_ .-]?de[_ .-]?compra|(?<![a-z])ocs?(?![a-z])|ilovepdf|\d{3,}-\d{1,4}-(?:se|ag|cm|co)\d{2}(?!\d)"
HISTORY_TEXT = r"nombre\s+orden\s+de\s+compra|n[uú]mero\s+de\s+orden\s+de\s+compra|orden\s+de\s+compra\s*(?:n\W|:)"

#: Families of products that belong to one brand.
FAMILY_BRANDS = {
    "probook": "HP", "elitebook": "HP", "zbook": "HP", "proone": "HP", "prodesk": "HP", "elitedesk": "HP", "eliteone": "HP", "pavilion": "HP",
    "laserjet": "HP", "officejet": "HP", "deskjet": "HP", "smart tank": "HP", "victus": "HP", "omen": "HP", "thinkpad": "Lenovo", "thinkbook": "Lenovo",
    "ideapad": "Lenovo", "thinkcentre": "Lenovo", "legion": "Lenovo", "loq": "Lenovo", "yoga": "Lenovo", "latitude": "Dell", "optiplex": "Dell", "vostro": "Dell",
    "inspiron": "Dell", "vivobook": "ASUS", "expertbook": "ASUS", "zenbook": "ASUS", "expertcenter": "ASUS", "macbook": "Apple", "imac": "Apple", "aspire": "Acer",
    "swift": "Acer", "nitro": "Acer", "travelmate": "Acer", "veriton": "Acer", "ecotank": "Epson", "workforce": "Epson", "pixma": "Canon",
}
#: Brands that a description may name.
BRANDS_IN_TEXT = ("HP", "Lenovo", "Dell", "ASUS", "Acer", "Apple", "Samsung", "Epson", "Canon", "Brother", "MSI", "LG", "Xerox", "Kyocera", "Ricoh", "Lexmark", "ViewSonic", "AOC", "Philips", "Gigabyte", "Huawei", "Xiaomi", "Zebra", "Logitech")
#: Words that make a description a requirement, so that a brand in it is none.
REQUIREMENT = r"equivalent|similar|\btipo\b|o superior|compatible|segun bases"
#: Aliases by which the audit sees a brand in a text.
BRAND_SEEN_AS = {"hp": ("hp", "hewlett"), "asus": ("asus",), "lenovo": ("lenovo", "thinkpad", "ideapad")}

#: Rows of a count, a kind and one amount.
GENERIC_NAME = r"notebooks?|laptops?|port[aá]tiles?|computador(?:es|as?)?|equipos?(?:\s+computacionales)?|monitor(?:es)?|pantallas?|impresoras?|multifuncional(?:es)?|all\s*in\s*one|aio|desktops?|pcs?|estaciones?\s+de\s+trabajo|workstations?"
WITH_VAT = r"con\s+iva|iva\s+incluido|impuestos?\s+incluidos?|valor\s+bruto"

#: Attachments that bear no offer.
STRICT_EQUIPMENT = r"notebook|laptop|port[aá]til|computador|all.?in.?one|\baio\b|desktop|workstation|monitor|impresora|multifuncional"
BRAND_OR_FAMILY = r"(?<![A-Za-z0-9])(?:hp|lenovo|dell|asus|acer|apple|samsung|epson|canon|brother|msi|lg|xerox|kyocera|ricoh|lexmark|viewsonic|aoc|philips|gigabyte|huawei|xiaomi|zebra|thinkstation|workstation|precision|estaci[oó]n de trabajo)(?![A-Za-z0-9])"
ADMIN_NOISE = r"carnet|c[eé]dula|(?<![a-z])rut(?![a-z])|poder|escritura|patente|tributari|certificad|declaraci|integridad|pacto|constituci[oó]n|f[-_ ]?30|antecedentes|inhabilidad|boleta|seriedad|firma|sello|vigencia|anotaciones|domicilio|resoluci[oó]n"
ADMIN_USEFUL = r"cotiz|econ[oó]m|oferta|precio|ficha|t[eé]cnic|especific|(?<![a-z])ft(?![a-z])|catalogo"
ATTACHMENT_USEFUL = r"cotiz|ofert(?!ente)|econ[oó]m|precio|valor|ficha|t[eé]cnic|especific|propuesta|cat[aá]logo|resumen|equipo|notebook|computador|monitor|impresora|producto|(?<![a-z])item|(?<![a-z])lote"
ATTACHMENT_NOISE = r"declara|certific|(?<![a-z])rut(?![a-z])|carnet|c[eé]dula|poder|escritura|integridad|pacto|boleta|patente|tribut|f[-_ ]?30(?!\d)|antecedente|identificaci|seriedad|constituci|vigencia|experiencia|orden(?:es)?[ _-]*de[ _-]*compra|(?<!\d)\d{3,7}-\d{1,4}-(?:se|ag|cm|co|ac|sb)\d{0,2}(?![a-z])|curr[ií]cul|inhabilidad|sello|pol[ií]tica|balance|financier|compromiso|post[ _-]*venta|simult|conflicto|reciclaj|iso[ _-]?\d|bancari|cuenta[ _-]corriente|mujer|pyme|chileproveedores|garant[ií]a|prevenci|delito|factura|interactivo|sociedad|(?<![a-z])c\.?i\.?(?![a-z])|(?<![a-z])oc(?![a-z])"
NOISE_NAME = r"iso[_ .-]?\d|certificad|pacto|integridad|reciclaj|etiqueta|p[oó]liza|garant[ií]a|declaraci[oó]n|experiencia|orden[_ .-]?de[_ .-]?compra|energy[_ .-]?star|epeat|blue[_ .-]?angel|gu[ií]a[_ .-]?de[_ .-]?compra|foro"

#: Roles of documents.
ROLE_PREFIXES = ("economico", "tecnico", "administrativo")
THOUSANDS_AMOUNT = r"(?<![\w.,])(\d{1,3}(?:[.,]\d{3})+)(?![\d])"
PRICE_KEY = r"\$|\b(?:neto|iva|valor\s*(?:unit|total|neto)|precio|p\.?\s*unit|monto|subtotal)"
QUANTITY_KEY = r"\b(?:cantidad|cant\.?|unidades|unid\.?|qty|n[°º]\s*de\s*equipos)\b"
GENERIC_LINE = r"\b(?:computador(?:es)?|notebooks?|equipos?|monitor(?:es)?|impresoras?|all\s*in\s*one|aio|pc|laptops?)\b"
UNIT_PRICE = r"(?:valor|precio)\s*unitario|p\.\s*unit"
SMALL_NUMBER = r"(?<![\w.,/-])\d{1,4}(?![\w.,/-])"
ADMIN_TEXT = r"declaraci[oó]n\s+jurada|garant[ií]a\s+de\s+seriedad|poder\s+notarial|certificado\s+de|inhabilidad|pacto\s+de\s+integridad|formulario\s+de\s+identificaci"
TECHNICAL_TEXT = r"procesador|memoria\s+ram|\bram\b|\bssd\b|disco\s+duro|pantalla|sistema\s+operativo|resoluci[oó]n|garant[ií]a\s+\d|especificaci[oó]n"
COMMON_WORDS = ("notebook", "notebooks", "computador", "computadores", "equipo", "equipos", "monitor", "monitores", "impresora", "impresoras", "intel", "core", "para", "con", "similar", "marca", "modelo", "pulgadas", "pantalla", "memoria", "disco", "windows", "procesador", "unidad", "unidades", "tipo", "linea", "serie", "nuevo", "nueva")
GENERIC_WORDS = ("notebook", "laptop", "computador", "computadora", "desktop", "equipo", "monitor", "impresora", "multifuncional", "tipo", "unidad", "unidades", "precio", "total")
EMPTY_WORDS = ("de", "del", "la", "el", "los", "las", "con", "para", "por", "en", "una", "gb", "ram", "ssd")

#: Codes that name a component or a measure, not a model.
COMPONENT_CODE = r"^(?:\d+(?:gb|tb|mb|hz|mhz|ghz|w|wh|mah|mm|cm|pulg)|ddr\d\w*|lpddr\d\w*|i[3579]-?\d+\w*|r[3579]-?\d+\w*|w1[01]\w*|win1[01]\w*|usb\d?\w*|hdmi\d?\w*|wifi\d?\w*|wi-fi\d?\w*|pcie\d?\w*|gen\d+|\d+th|\d+(?:a|v)|fhd\w*|uhd\w*|wuxga\w*|4k\w*|rtx\w*|gtx\w*|nvme\w*|m\.?2\w*)$"

#: Errors of a model service that go away when asked again.
TRANSIENT_ERROR = r"channel\s*error|model\s+(?:is\s+)?(?:loading|unloaded)|no\s+models?\s+loaded|connection\s+(?:reset|closed)"
