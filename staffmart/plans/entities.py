"""Raw-file contracts of the six entities: separators, columns, rename maps.

Everything here is a fixed value that must match the raw files and the
silver schemas, stated once.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Level descriptions (position hierarchy), lowest to highest.
LEVELS = ["Estagiário", "Analista", "Coordenador", "Gerente", "Diretor"]

# Known misspellings in the area column and their corrections.
AREA_CORRECTIONS = {"Logísitca": "Logística"}

# Positions file, ';', in file order; one overflow cell catches shifted rows.
POSITIONS_SEP = ";"
POSITIONS_COLUMNS = ["Cargo", "Nível", "Área", "COD Área", "COD Nível", "Quadro", "Bonus",
                     "Contratacao"]
POSITIONS_RENAME = {
    "Cargo": "level",
    "Nível": "level_description",
    "Área": "area",
    "COD Área": "cod_area",
    "COD Nível": "cod_level",
    "Quadro": "quadro",
    "Bonus": "bonus",
    "Contratacao": "hiring",
}

# Postal file, '|' with some doubled separators.
POSTAL_SEP = "|"
POSTAL_COLUMNS = ["CEP", "Estado", "Região"]
POSTAL_RENAME = {"CEP": "cep", "Estado": "state", "Região": "region"}

# Customers file, ';': seven named columns and five unnamed trailing cells.
CUSTOMERS_SEP = ";"
CUSTOMERS_COLUMNS = ["Cliente", "Valor Contrato Anual", "Quantidade de Serviços",
                     "Cargo Responsável", "CEP", "Data Início Contrato",
                     "Nivel de Importancia"]
CUSTOMERS_OVERFLOW = 5
CUSTOMERS_RENAME = {
    "Cliente": "customer",
    "Valor Contrato Anual": "annual_contract_value",
    "Quantidade de Serviços": "number_of_services",
    "Cargo Responsável": "responsible_position",
    "CEP": "cep",
    "Data Início Contrato": "contract_start_date",
    "Nivel de Importancia": "importance_level",
}
IMPORTANCE_LEVELS = [1, 2, 3, 4]

# Employees file, '|': names come from the header; every other header cell is
# empty (Spark names those _c1, _c3, ...).
EMPLOYEES_SEP = "|"
EMPLOYEES_FILLERS = [f"_c{i}" for i in range(1, 53, 2)]
EMPLOYEES_RENAME = {
    "ID RH": "hr_id",
    "RG": "id_card_number_rg",
    "CPF": "cpf",
    "Ramal": "extension",
    "Estado Civil": "marital_status",
    "Nome Completo": "full_name",
    "Login": "login",
    "Data de Nascimento": "birth_date",
    "CEP": "cep",
    "Data de Contratacao": "hire_date",
    "Data de Demissao": "termination_date",
    "Dias Uteis Trabalhados Ano Orcamentario": "workdays_in_fiscal_year",
    "Salario Base": "base_salary",
    "Impostos": "taxes",
    "Beneficios": "benefits",
    "VT": "transport_voucher",
    "VR": "meal_voucher",
    "Cargo": "position",
    "Bandeira": "flag",
    "Codigos": "codes",
    "Quantidade de Acessos": "access_count",
    "Ferias Acumuladas": "accumulated_vacation",
    "Ferias Remuneradas": "paid_vacation",
    "Horas Extras": "overtime_hours",
    "Valores Adicionais": "additional_amounts",
    "ID de Pessoal": "personnel_id",
    "ID da area": "department_id",
}

# Levels file, '%'.
LEVELS_SEP = "%"
LEVELS_RENAME = {"Nível": "level", "Descrição Nível": "level_description",
                 "Tempo no Nível": "time_on_level"}

# Partner-staff ("PQ") file, ';', with repeated header names (Spark appends
# the position to a repeated name: Cargo17, Nível43, Nível51).
PQ_SEP = ";"
PQ_COLUMNS = ["ID RH", "RG", "CPF", "Ramal", "Estado Civil", "Nome Completo", "Login",
              "Data de Nascimento", "CEP", "Data de Contratacao", "Data de Demissao",
              "Dias Uteis Trabalhados Ano Orcamentario", "Salario Base", "Impostos",
              "Beneficios", "VT", "VR", "Cargo17", "Nível43", "Nível51", "Bandeira",
              "Codigos", "Quantidade de Acessos", "Ferias Acumuladas", "Ferias Remuneradas",
              "Horas Extras", "Valores Adicionais"]
PQ_RENAME = dict(EMPLOYEES_RENAME, **{"Cargo17": "responsible_position",
                                      "Nível43": "level_description",
                                      "Nível51": "level"})

# Personal data: token columns and the vault layout.
TOKENS = {"cpf": "cpf_encrypted", "id_card_number_rg": "rg_encrypted"}
VAULT_COLUMNS = ["id_card_number_rg", "cpf", "full_name", "cpf_encrypted", "rg_encrypted",
                 "login"]
CLEAR_COLUMNS = ["id_card_number_rg", "cpf", "full_name", "login"]

# Money columns of employees: decimal(18,2), exactly.
EMPLOYEE_DECIMALS = ["base_salary", "taxes"]

# Limits of the employee rules.
TAXES_PATTERN = r"^\d+\.?\d*$"
EARLIEST_BIRTH = "1900-01-01"
# ----------------------------------------------------------- end fixed values
