"""Company names with the label and the market segment that each must get.

The party fixture draws on them, and the SQL check compares with what stands
here, not with the rules.  Four labels of the rule list can't be reached (a
later rule matches whenever theirs does), and two are lost when names are
cleaned ('&' goes, 'estacio de sa' gets a company marker).
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
BRANDS = [
    ("Fazenda Do Estado", "regex_fazenda", "fazenda"),
    ("Ministerio Publico", "regex_mpublico", "ministerio_publico"),
    ("Municipio", "regex_municipio", "municipio"),
    ("Claro", "regex_claro", "telecomunicacoes"),
    ("Rio Claro", "regex_rio_claro", "telecomunicacoes"),
    ("Nextel", "regex_nextel", "telecomunicacoes"),
    ("Telemar", "regex_oi", "telecomunicacoes"),
    ("Unibanco", "regex_itau", "bancos_cartoes_financeiras"),
    ("Banco A J Renner", "regex_renner", "bancos_cartoes_financeiras"),
    ("Crefisa", "regex_crefisa", "recuperacao_credito"),
    ("Cdl Dirigentes Lojistas", "regex_cdl_porto_alegre", "banco_de_dados"),
    ("Credifibra", "regex_banco_credifibra", "bancos_cartoes_financeiras"),
    ("Farroupilha", "regex_farroupilha_consorcios", "bancos_cartoes_financeiras"),
    ("Banco Cacique", "regex_cacique", "bancos_cartoes_financeiras"),
    ("Schahin", "regex_schahin", "bancos_cartoes_financeiras"),
    ("Aymore", "regex_aymore", "bancos_cartoes_financeiras"),
    ("Bradesc", "regex_bradesco", "bancos_cartoes_financeiras"),
    ("Light", "regex_light", "energia_gas_agua_esgoto"),
    ("Estado Do Rio De Janeiro", "regex_rio", "regex_rio"),
    ("Santander", "regex_santander", "bancos_cartoes_financeiras"),
    ("Tim", "regex_tim", "telecomunicacoes"),
    ("Ampla", "regex_ampla", "energia_gas_agua_esgoto"),
    ("Via Varejo", "regex_vvar", "varejo"),
    ("Bmg", "regex_bmg", "bancos_cartoes_financeiras"),
    ("Banco Do Brasil", "regex_bb", "bancos_cartoes_financeiras"),
    ("Sky", "regex_sky", "telecomunicacoes"),
    ("Vivo", "regex_vivo", "telecomunicacoes"),
    ("Ricardo Eletro", "regex_ricardoeletro", "varejo"),
    ("Net", "regex_net", "telecomunicacoes"),
    ("Banco Pan", "regex_panamericano", "bancos_cartoes_financeiras"),
    ("Cedae", "regex_cedae", "energia_gas_agua_esgoto"),
    ("Leader", "regex_leader", "regex_leader"),
    ("Bv Financeira", "regex_bv", "bancos_cartoes_financeiras"),
    ("Amil", "regex_amil", "planos_de_saude"),
    ("Seguradora Lider", "regex_lider", "seguros"),
    ("Cnova", "regex_cnova", "comercio_eletronico"),
    ("Samsung", "regex_samsung", "fabricantes_eletrocnicos"),
    ("Tam", "regex_tam", "transporte_aereo"),
    ("Lojas Americanas", "regex_lame", "varejo"),
    ("Unimed", "regex_unimed", "planos_de_saude"),
    ("B2W", "regex_b2w", "regex_b2w"),
    ("Electrolux", "regex_electrolux", "fabricantes_linha_branca"),
    ("Citibank", "regex_citi", "bancos_cartoes_financeiras"),
    ("Mrv", "regex_mrv", "regex_mrv"),
    ("Estacio De Sa", "estacio de @s@a@", "estacio de @s@a@"),
    ("Qualicorp", "regex_qualicorp", "planos_de_saude"),
    ("Carrefour", "regex_carrefour", "supermercados"),
    ("Daycoval", "regex_daycoval", "bancos_cartoes_financeiras"),
    ("Hsbc", "regex_hsbc", "bancos_cartoes_financeiras"),
    ("Bonsucesso", "regex_bonsucesso", "bancos_cartoes_financeiras"),
    ("Ibi", "regex_ibi", "recuperacao_credito"),
    ("Cruzeiro Do Sul", "regex_cruzeiro_do_sul", "bancos_cartoes_financeiras"),
    ("Bgn", "regex_bgn", "bancos_cartoes_financeiras"),
    ("Cielo", "regex_cielo", "fabricantes_eletrocnicos"),
    ("Zurich", "regex_zurich", "seguros"),
    ("Vrg", "regex_gol", "transporte_aereo"),
    ("Sony", "regex_sony", "fabricantes_eletrocnicos"),
    ("Sendas", "regex_sendas", "varejo"),
    ("Safra", "regex_safra", "bancos_cartoes_financeiras"),
    ("Golden Cross", "regex_golden_cross", "transporte_aereo"),
    ("Banco Mercantil", "regex_banco_mercantil", "bancos_cartoes_financeiras"),
    ("Avista", "regex_avista", "regex_avista"),
    ("Digibras", "regex_digibras", "regex_digibras"),
    ("Inss", "regex_inss", "regex_inss"),
    ("Volkswagen", "regex_volkswagen", "bancos_cartoes_financeiras"),
    ("Energisa", "regex_energisa", "energia_gas_agua_esgoto"),
    ("Estado De Mato Grosso Secretaria Estadual De Saude", "regex_secretaria_de_saude_mt", "regex_secretaria_de_saude_mt"),
    ("Azul Linhas", "regex_azul", "transporte_aereo"),
    ("Serasa", "regex_serasa", "banco_de_dados"),
    ("Spc", "regex_spc", "banco_de_dados"),
    ("Porto Seguro", "regex_porto_seguro", "seguros"),
    ("Avon", "regex_avon", "perfumaria"),
    ("Finasa", "regex_banco_finasa", "bancos_cartoes_financeiras"),
    ("Natura", "regex_natura", "perfumaria"),
    ("Tokio Marine", "regex_tokio_marine", "regex_tokio_marine"),
    ("Ford", "regex_ford", "bancos_cartoes_financeiras"),
    ("Banco Da Amazonia", "regex_basa", "regex_basa"),
    ("Pdg", "regex_pdg", "regex_pdg"),
    ("Furnas", "regex_furnas", "energia_gas_agua_esgoto"),
    ("Cef", "regex_cef", "bancos_cartoes_financeiras"),
    ("Mapfre", "regex_mapfre", "seguros"),
    ("Cvc", "regex_cvc", "agencias_de_viagem"),
    ("Honda", "regex_honda", "regex_honda"),
    ("Catho", "regex_catho", "regex_catho"),
    ("Buscape", "regex_buscape", "comercio_eletronico"),
    ("Abn Amro", "regex_abn", "bancos_cartoes_financeiras"),
    ("Riachuelo", "regex_riachuelo", "varejo"),
    ("Banco Rural", "regex_banco_rural", "bancos_cartoes_financeiras"),
    ("Banco Gmac", "regex_banco_gmac", "bancos_cartoes_financeiras"),
    ("Renova", "regex_renova", "regex_renova"),
    ("Supermercado Modelo", "regex_modelo", "regex_modelo"),
    ("Philips", "regex_philips", "regex_philips"),
    ("Positivo", "regex_positivo", "fabricantes_eletrocnicos"),
    ("Lg", "regex_lg", "fabricantes_eletrocnicos"),
    ("Lenovo", "regex_lenovo", "fabricantes_eletrocnicos"),
    ("Magazine Luiza", "regex_magazine_luiza", "varejo"),
    ("Pernambucanas", "regex_pernambucanas", "varejo"),
    ("Brastemp", "regex_brastempo", "fabricantes_linha_branca"),
    ("Consul", "regex_consul", "fabricantes_linha_branca"),
    ("Esmaltec", "regex_esmaltec", "fabricantes_linha_branca"),
    ("Atlas", "regex_atlas", "fabricantes_linha_branca"),
    ("Latina", "regex_latina", "fabricantes_linha_branca"),
    ("Mueller", "regex_mueller", "fabricantes_linha_branca"),
    ("Multiplus", "regex_multiplus", "programas_de_fidelidade"),
    ("Smiles", "regex_smiles", "programas_de_fidelidade"),
    ("Dotz", "regex_dotz", "programas_de_fidelidade"),
    ("Livelo", "regex_livelo", "programas_de_fidelidade"),
    ("Avianca", "regex_avianca", "transporte_aereo"),
    ("Cab Cuiaba", "regex_cab_cuiaba", "energia_gas_agua_esgoto"),
    ("Losango", "regex_losango", "bancos_cartoes_financeiras"),
    ("Novo Mundo Moveis", "regex_novo_mundo_moveis_mt", "regex_novo_mundo_moveis_mt"),
    ("Calcard", "regex_calcar", "regex_calcar"),
    ("Ativos", "regex_ativos", "recuperacao_credito"),
    ("Sanecap", "regex_sanecap_mt", "energia_gas_agua_esgoto"),
    ("Prime Incorporacoes", "regex_prime_mt", "regex_prime_mt"),
    ("General Motors", "regex_general_motors", "regex_general_motors"),
    ("Lotufo", "regex_lotufo_engenharia", "regex_lotufo_engenharia"),
    ("Sul America", "regex_sulamerica", "seguros"),
    ("Omni Financeira", "regex_omni", "regex_omni"),
    ("Brookfield", "regex_brookfield_incorporadora", "regex_brookfield_incorporadora"),
    ("Banrisul", "regex_banrisul", "bancos_cartoes_financeiras"),
    ("Boa Vista", "regex_boa_vista", "banco_de_dados"),
    ("Ace", "regex_ace", "seguros"),
    ("Aes Sul", "regex_aes_sul", "energia_gas_agua_esgoto"),
    ("Ceee", "regex_ceee", "energia_gas_agua_esgoto"),
    ("Cifra", "regex_cifra", "bancos_cartoes_financeiras"),
    ("Corsan", "regex_corsan", "energia_gas_agua_esgoto"),
    ("Rio Grande Energia", "regex_rio_grande_energia", "energia_gas_agua_esgoto"),
    ("Sofisa", "regex_sofisa", "bancos_cartoes_financeiras"),
    ("Cce", "regex_cce", "fabricantes_eletrocnicos"),
    ("Getnet", "getnet", "pagamento_eletronico"),
]
# ----------------------------------------------------------------------------
