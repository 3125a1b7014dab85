"""From raw records to warehouse rows, and from warehouse tables to mart rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, day_text, moment_text, query
from jornada.operators import flatten
from jornada.plans import dimensions, facts, marts

_MART_ENTRIES = f"""
    select e.time_entry_sesame_id as imputacion_id, m.empleado_sesame_id as empleado_id, m.nombre as nombres,
           m.apellidos, d.department_name as nombre_departamento, {day_text("time_entry_in")} as fecha,
           cast(year(time_entry_in) as int) as "year", cast(month(time_entry_in) as int) as mes,
           p.customer_name as nombre_cliente, p.customer_sesame_id as id_cliente, p.project_name as nombre_proyecto,
           e.project_sesame_id as id_proyecto, e.tags as etiquetas, strftime(time_entry_in, '%H:%M') as hora_inicio,
           strftime(time_entry_out, '%H:%M') as hora_fin, m.costo_hora_empresa,
           (epoch_us(time_entry_out) - epoch_us(time_entry_in)) / 3.6e9 as horas_imputadas
    from ({roles.ENTRIES}) as e
    left join ({roles.PROJECTS}) as p on p.project_sesame_id = e.project_sesame_id
    left join ({roles.EMPLOYEES}) as m on m.empleado_sesame_id = e.employee_sesame_id
    left join ({roles.LATEST_ASSIGNMENTS}) as a on a.employee_sesame_id = e.employee_sesame_id
    left join ({roles.DEPARTMENTS}) as d on d.department_sesame_id = a.department_sesame_id
    where cast(time_entry_in as date) between date '{roles.FROM_DATE}' and date '{roles.TO_DATE}'"""


@query("mart_time_entries", _MART_ENTRIES)
def mart_time_entries(t: Tables) -> DataFrame:
    return marts.mart_time_entries(
        roles.entries(t),
        roles.projects(t),
        roles.employees(t),
        roles.assignments(t),
        roles.departments(t),
        roles.FROM_DATE,
        roles.TO_DATE,
    )


_HOURS_FROM, _HOURS_TO = "1996-01-01", "2000-12-31"


@query(
    "mart_worked_hours",
    f"""select "employeeId" || '/' || {day_text('"date"')} as fichaje_diario_id, "employeeId" as empleado_id,
               s.nombre as nombres, s.apellidos, {day_text('"date"')} as fecha,
               "secondsToWork" / 3600.0::double as tiempo_teorico, "secondsWorked" / 3600.0::double as tiempo_trabajado
        from ({roles.DAILY}) as d
        left join ({roles.SUPPLIERS_AS_EMPLOYEES}) as s on s.empleado_sesame_id = d."employeeId"
        where "date" between date '{_HOURS_FROM}' and date '{_HOURS_TO}'""",
)
def mart_worked_hours(t: Tables) -> DataFrame:
    name = F.concat_ws("/", "employee_sesame_id", F.date_format("date", "yyyy-MM-dd"))
    fact = facts.worked_hours(roles.clock_records(t)).withColumn("worked_hours_id", name)
    return marts.mart_worked_hours(fact, roles.suppliers_as_employees(t), _HOURS_FROM, _HOURS_TO)


@query("pipe_departments", roles.DEPARTMENTS)
def pipe_departments(t: Tables) -> DataFrame:
    raw = t.region.select(roles.text("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return dimensions.departments(flatten.flatten_departments(raw))


@query(
    "pipe_assignments",
    f"""select id as department_assignation_sesame_id, employee_id as employee_sesame_id,
               department_id as department_sesame_id,
               {moment_text("strptime(substr(created_at, 1, 19), '%Y-%m-%dT%H:%M:%S') - interval 2 hour")}
                   as creation_date,
               {moment_text("strptime(substr(updated_at, 1, 19), '%Y-%m-%dT%H:%M:%S') - interval 2 hour")}
                   as update_date
        from ({roles.RAW_ASSIGNMENTS}) as r""",
)
def pipe_assignments(t: Tables) -> DataFrame:
    return dimensions.department_assignments(flatten.flatten_department_assignments(roles.raw_assignments(t)))


@query(
    "pipe_projects",
    """select cast(p_partkey as varchar) as project_sesame_id, p_name as project_name,
              case when p_type = 'PROMO' then '' else p_brand end as customer_sesame_id,
              case when p_type = 'PROMO' then '' else 'Client ' || p_brand end as customer_name,
              lower(p_type) as project_status from part""",
)
def pipe_projects(t: Tables) -> DataFrame:
    return dimensions.projects(flatten.flatten_projects(roles.raw_projects(t)))


@query(
    "project_rename",
    """select cast(p_partkey as varchar) as id, p_name as name,
              case when p_type = 'PROMO' then '' else p_brand end as customer_id,
              case when p_type = 'PROMO' then '' else 'Client ' || p_brand end as customer_name,
              p_retailprice as price, lower(p_type) as project_status,
              cast(null as varchar) as external_project_id from part""",
)
def project_rename(t: Tables) -> DataFrame:
    return flatten.flatten_projects(roles.raw_projects(t))


def _unless_automobile(expression: str) -> str:
    return f"case when c_mktsegment <> 'AUTOMOBILE' then {expression} end"


_BLANK = ", ".join(
    f"'' as {name}"
    for name in (
        "contrato_sesame_id ssn nucleo_negocio ciudad provincia estatus_marital codigo_categoria_profesional "
        "categoria_profesional bic cargo_trabajo_sesame_id cargo_trabajo numero_cuenta rango_salarial"
    ).split()
)


@query(
    "pipe_employees",
    f"""with companies as (
            select home.n_nationkey as home_key, min(dim.n_nationkey) as empresa_id
            from nation as home join nation as dim on contains('company ' || lower(home.n_name), lower(dim.n_name))
            group by 1)
        select cast(c_custkey as varchar) as empleado_sesame_id, c_name as nombre, c_mktsegment as apellidos,
               lower(c_name) || '@example.org' as email, substr(c_name, 10, 9) as telefono,
               {_unless_automobile("substr(c_name, 10, 4)")} as telefono_corto,
               'Company ' || lower(n_name) || ' ' || chr(9) as empresa_sesame_id,
               case when c_mktsegment <> 'MACHINERY' then 'x' else '' end as sexo,
               coalesce({roles.NATIONAL_ID}, '') as nid,
               case when c_acctbal >= 0 then c_acctbal else 0 end as costo_hora,
               case when c_mktsegment <> 'FURNITURE' then '1990-05-17' end as fecha_nacimiento,
               coalesce({_unless_automobile("c_mktsegment")}, '') as area,
               {_unless_automobile("c_acctbal")} as costo_hora_empresa,
               case when c_mktsegment <> 'AUTOMOBILE' and c_nationkey between 1 and 12
                    then strftime(make_date(2020, c_nationkey, 3), '%Y-%m-%d') end as fecha_alta,
               case when c_mktsegment = 'BUILDING' then 'degree' else '' end as estudios,
               case when c_acctbal >= 0 then 'active' else 'inactive' end as estado,
               case when c_mktsegment <> 'BUILDING' then c_nationkey else 0 end as num_hijos,
               case when c_mktsegment = 'BUILDING' then 33.5::double else 0 end as porcentaje_discapacidad,
               c_name as direccion, substr(c_name, 10, 5) as codigo_postal, n_name as pais, n_name as nacionalidad,
               c_mktsegment as nivel_estudio, empresa_id,
               case when c_mktsegment = 'BUILDING' then 'passport' else '' end as tipo_nid,
               {_unless_automobile("'2023-11-30'")} as fecha_baja, {_BLANK}
        from customer join nation on c_nationkey = n_nationkey join companies on home_key = n_nationkey""",
)
def pipe_employees(t: Tables) -> DataFrame:
    flat = flatten.flatten_employees(roles.raw_employees(t))
    return dimensions.employees(flat, roles.companies(t))[0]


@query(
    "pipe_time_entries",
    f"""select id as time_entry_sesame_id, project_id as project_sesame_id,
               {moment_text("time_in")} as time_entry_in, {moment_text("time_out")} as time_entry_out,
               tags, substr(comment, 1, 200) as comment, employee_id as employee_sesame_id
        from ({roles.RAW_TIME_ENTRIES}) as r""",
)
def pipe_time_entries(t: Tables) -> DataFrame:
    return facts.time_entries(flatten.flatten_time_entries(roles.raw_time_entries(t)))


@query(
    "pipe_worked_hours",
    f"""select "employeeId" as employee_sesame_id, {day_text('"date"')} as "date", "secondsWorked" as worked_time,
               "secondsToWork" as to_work_time from ({roles.DAILY}) as d""",
)
def pipe_worked_hours(t: Tables) -> DataFrame:
    return facts.worked_hours(roles.clock_records(t))


def _profile_tables(t: Tables) -> tuple[DataFrame, ...]:
    people = flatten.flatten_employees(roles.raw_employees(t))
    ids = t.customer.select(roles.national_id().alias("nid"), F.col("c_custkey").alias("empleado_id"))
    assigned = flatten.flatten_department_assignments(roles.raw_assignments(t))
    return people, ids, roles.companies(t), assigned, roles.legacy_departments(t)


_PROFILES = f"""
    select cast(c_custkey as varchar) as id, 'Grupo ' || n_name || ' SL ' as cliente, empleado_id,
           case when c_acctbal >= 0 then c_acctbal end as precio_hora, empresa_id,
           case when contains(lower(department_name), 'urgent') then 0
                when contains(lower(department_name), 'high') then 1
                when contains(lower(department_name), 'medium') then 2
                when contains(lower(department_name), 'not') then 3 else 35 end as departamento_id
    from customer
    join nation on c_nationkey = n_nationkey
    join (select home.n_nationkey as home_key, min(dim.n_nationkey) as empresa_id
          from nation as home join nation as dim on contains(lower(home.n_name), lower(dim.n_name)) group by 1) as co
        on home_key = n_nationkey
    left join (select {roles.NATIONAL_ID} as nid, max(c_custkey) as empleado_id from customer group by 1) as ids
        on ids.nid = {roles.NATIONAL_ID}
    left join (select employee_id, arg_max(department_name, struct_pack(a := updated_at, b := id)) as department_name
               from ({roles.RAW_ASSIGNMENTS}) as r group by 1) as asg
        on asg.employee_id = cast(c_custkey as varchar)"""


@query(
    "pipe_time_charges",
    f"""select {day_text("time_in")} as fecha, coalesce(comment, '') as tarea, cliente, project_id as proyecto,
               case when tags = '' then 'No especificada' else tags end as etiqueta, precio_hora,
               (epoch_us(time_out) - epoch_us(time_in)) / 3.6e9 as horas_imputadas,
               empresa_id, departamento_id, empleado_id
        from ({roles.RAW_TIME_ENTRIES}) as e join ({_PROFILES}) as p on p.id = e.employee_id
        where precio_hora is not null and empleado_id is not null and project_id <> ''""",
)
def pipe_time_charges(t: Tables) -> DataFrame:
    entries = flatten.flatten_time_entries(roles.raw_time_entries(t))
    return facts.time_charges(entries, facts.charge_profiles(*_profile_tables(t)))


@query(
    "pipe_signings",
    f"""select {day_text('"date"')} as fecha, cast("secondsToWork" as double) as tiempo_teorico,
               cast("secondsWorked" as double) as tiempo_trabajado, empresa_id, departamento_id, empleado_id
        from ({roles.DAILY}) as d join ({_PROFILES}) as p on p.id = d."employeeId"
        where empleado_id is not null""",
)
def pipe_signings(t: Tables) -> DataFrame:
    return facts.signings(roles.clock_records(t), facts.signing_profiles(*_profile_tables(t)))
